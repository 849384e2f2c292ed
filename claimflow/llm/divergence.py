"""Source divergence audit: term counts by Arrow kernels, merged shards, divergences (operator 11).

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. Each
language keeps the terms of at least ``least_docs`` of its rows. With a count c,
the sum N of a group's counts over the V kept terms of its language, and D = N + V:

    p = 1 + floor(10**9 * (c + 1) / D),    f(p, q) = floor((p - q)**2 / q)

A group is an occurring (lang, source). Part ``pair`` has, for every other source
of the language, the sum of f over all kept terms, q being the other's p; part
``term`` the kept terms of the group with p over the language's q, and their f, the
first ``top`` of them. All arithmetic is on integers.

Tasks count the terms of slices of texts with Arrow kernels: lower-case, split,
dictionary-encode, hash group-by. Spark adds the partial counts up. The kept
counts of a language are dealt by term into shards of about ``SHARD_ROWS`` rows,
so a hot language is many shards; each shard builds, block by block, a column of
counts per source and adds up the divergences of its terms.

Null text, language and source are ''. A group without terms counts 0 for each;
a language without kept terms has pairs of value 0 and no terms. Rows that repeat
are rows of their own. Ties rank by the UTF-8 bytes of the item. An empty table
gives no rows. Columns other than the three named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .textnum import runs, text_bytes

#: What stands between terms: ASCII other than letters.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_IS_BREAK = np.array([i < 128 and not chr(i).isalpha() for i in range(256)])

#: Bytes of text counted at a time; a longer text is counted in pieces.
SLICE = 8 << 20
#: Counts of one shard, and cells of its block of columns.
SHARD_ROWS, BLOCK_CELLS = 250_000, 1 << 21

COUNTS = "lang string, source string, term string, n bigint, n_docs bigint"
SCALE_STEPS, STEP = 3, 1000     # 10**9 = 1000**3


def _terms_of(text: pa.Array) -> tuple[pa.Array, pa.DictionaryArray]:
    """The row of each term, and the terms, encoded by a dictionary."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BREAKS)
    rows, terms = pc.list_parent_indices(lists), pc.list_flatten(lists)
    some = pc.greater(pc.binary_length(terms), 0)
    return rows.filter(some), terms.filter(some).dictionary_encode()


def _per_row(text: pa.Array) -> pa.Table:
    """(row, term, n): the terms of each text with their counts."""
    rows, terms = _terms_of(text)
    found = pa.table({"row": rows, "code": terms.indices}).group_by(
        ["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"row": found["row"], "term": terms.dictionary.take(found["code"]), "n": found["count_all"]})


def _pieces(text: pa.Array, limit: int) -> Iterator[pa.Array]:
    """One long text as pieces of about ``limit`` bytes, cut where no term is."""
    data, _ = text_bytes(text)
    start = 0
    while start < len(data):
        stop = min(len(data), start + limit)
        while stop < len(data):     # on to the end of the term that stands here
            breaks = np.flatnonzero(_IS_BREAK[data[stop:stop + 4096]])
            stop = min(len(data), stop + (int(breaks[0]) if len(breaks) else 4096))
            if len(breaks):
                break
        yield pa.array([data[start:stop].tobytes().decode()])
        start = stop


def count_slice(text: pa.Array, lang: pa.Array, source: pa.Array, limit: int = SLICE) -> pa.Table:
    """Partial counts of some rows; a row with the term '' for each group."""
    if len(text) == 1 and text.nbytes > 2 * limit:
        parts = pa.concat_tables([_per_row(x) for x in _pieces(text, limit)])
        found = parts.group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(
            ["row", "term", "n"])
    else:
        found = _per_row(text)
    by = ["lang", "source", "term"]
    counts = pa.table({"lang": lang.take(found["row"]), "source": source.take(found["row"]), "term": found["term"],
                       "n": found["n"]})
    counts = counts.group_by(by, use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"], use_threads=False).aggregate([])
    zeros = pa.array(np.zeros(len(groups), np.int64))
    none = pa.table([groups["lang"], groups["source"], pa.array([""] * len(groups)), zeros, zeros],
                    names=["lang", "source", "term", "n", "n_docs"])
    counts = counts.select([*by, "n_sum", "n_count"]).rename_columns(none.column_names)
    return pa.concat_tables([counts, none])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, lang, source = (batch.column(i) for i in range(3))
        _, bounds = text_bytes(text)
        for i, j in runs(bounds, SLICE):
            yield from count_slice(*(c.slice(i, j - i) for c in (text, lang, source))).to_batches()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, n_docs), and a row with the term '' for each group."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                          for c, a in ((text, "text"), (lang, "lang"), (source, "source"))))
    return (named.mapInArrow(_counted, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))


def kept_counts(counts: DataFrame, least_docs: int = 3) -> DataFrame:
    """Counts of the kept terms with the language's ``total``; ``first`` marks one row of each term."""
    same = Window.partitionBy("lang", "term")
    return (counts.select("lang", "source", "term", "n", F.sum("n_docs").over(same).alias("docs"),
                          F.sum("n").over(same).alias("total"),
                          ((F.row_number().over(same.orderBy("source")) == 1) & (F.col("term") != "")).alias("first"))
            .where((F.col("docs") >= least_docs) | (F.col("term") == "")).drop("docs"))


def share(count: np.ndarray, whole) -> np.ndarray:
    """p of a count, exactly: the nine digits of (count + 1) / whole, three at a time."""
    rest, out = count + 1, np.zeros_like(count)
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        out = out * STEP + rest // whole
        rest = rest % whole
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


def _shard(top: int):
    def compare(_key, counts: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.combine_chunks().sort_by("source")
        sources = groups["source"]
        n = len(sources)
        column = lambda t, c: t[c].to_numpy().astype(np.int64)
        terms, lang_n = column(groups, "lang_terms")[0], column(groups, "lang_n")[0]
        whole = column(groups, "group_n") + terms
        sums = np.zeros((n, n), np.int64)
        coded = counts["term"].combine_chunks().dictionary_encode()
        code, of = coded.indices.to_numpy(), pc.index_in(counts["source"], value_set=sources.combine_chunks()).to_numpy()
        count, total = column(counts, "n"), column(counts, "total")
        order = np.argsort(code, kind="stable")
        block = max(1, BLOCK_CELLS // max(1, n))
        for lo in range(0, len(coded.dictionary), block):
            hi = min(lo + block, len(coded.dictionary))
            here = order[np.searchsorted(code, lo, sorter=order):np.searchsorted(code, hi, sorter=order)]
            cells = np.zeros((hi - lo, n), np.int64)
            cells[code[here] - lo, of[here]] = count[here]
            p = share(cells, whole)
            for s in range(n):
                sums[s] += divergence(p[:, s, None], p).sum(axis=0)
        a, b = np.nonzero(~np.eye(n, dtype=bool))
        pairs = [sources.take(pa.array(a)), pa.array(["pair"] * len(a), pa.string()), sources.take(pa.array(b)),
                 pa.array(sums[a, b])]
        p, q = share(count, whole[of]), share(total, lang_n + terms)
        over = np.flatnonzero((p > q) & (count > 0))
        found = pa.table({"source": pa.array(of[over]), "term": counts["term"].take(pa.array(over)),
                          "value": pa.array(divergence(p[over], q[over]))}).sort_by(
            [("source", "ascending"), ("value", "descending"), ("term", "ascending")])
        own = found["source"].to_numpy()
        first = np.flatnonzero(np.arange(len(own)) - np.searchsorted(own, own) < top)
        found = found.take(pa.array(first))
        best = [sources.take(found["source"]), pa.array(["term"] * len(found), pa.string()), found["term"], found["value"]]
        names = ["source", "part", "item", "value"]
        out = pa.concat_tables([pa.table(pairs, names=names), pa.table(best, names=names)])
        lang = pa.array([groups["lang"][0].as_py()] * len(out), pa.string())
        return out.add_column(0, "lang", lang)
    return compare


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least_docs: int = 3, top: int = 200, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs, and the ``top`` terms of each group."""
    kept = materialize(kept_counts(term_counts(docs, text, lang, source), least_docs), "kept-counts")
    groups = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("group_n"), F.count_if("first").alias("firsts"), F.count(F.lit(1)).alias("rows"))
    whole = groups.groupBy("lang").agg(
        F.sum("group_n").alias("lang_n"), F.sum("firsts").alias("lang_terms"),
        F.ceil(F.sum("rows") / F.lit(shard_rows)).cast("int").alias("shards"))
    groups = materialize(groups.drop("firsts", "rows").join(whole, "lang"), "groups")
    langs = groups.select("lang", "shards").distinct()
    dealt = (kept.where(F.col("term") != "").join(langs, "lang")
             .select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"),
                     "source", "term", "n", "total"))
    every = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
                          "source", "group_n", "lang_n", "lang_terms")
    parts = materialize(
        dealt.groupBy("lang", "shard").cogroup(every.groupBy("lang", "shard")).applyInArrow(
            _shard(top), "lang string, source string, part string, item string, value bigint"), "shard-divergences")
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = (parts.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item")
             .agg(F.sum("value").alias("value")).select("*", ranked))
    terms = parts.where(F.col("part") == "term").select("*", ranked).where(F.col("rank") <= top)
    return pairs.unionByName(terms)
