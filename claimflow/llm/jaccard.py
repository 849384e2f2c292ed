"""N-gram Jaccard join by MinHash banding (operator 2).

Texts are sets of word n-grams. They are lower-cased, and their words are runs
of digits, ASCII letters and non-ASCII characters: copies that differ in
marks, capitals or line breaks only are equal. Documents with equal sets are one node, known by its smallest document id.
The MinHash signature of a node is cut into bands; nodes that agree on a whole
band share a bucket, met by a shuffle on the band's hash. The numbers of bands
and rows follow from the target recall at the threshold (:func:`banding`).

All members of a bucket are compared with each other, by their full n-gram sets.
Buckets of the same members are one. A crowded bucket is cut into blocks, by size
first, as sets of too different sizes can't be near; two blocks make a cell, and
a task counts the n-grams that the pairs of its cells have in common. A pair that
meets in several buckets counts in that of its first common band. What leaves a
cell is a row for each of its linked members, not its pairs.

Null texts and texts without a word have no n-grams, no links, and a class of
their own; a text of fewer than n words is one n-gram. Rows that share an id
are one document. A null id sorts last. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import fresh, materialize
from .textnum import IS_MARK, mix, ngram_hashes, numbers, runs, signed, text_bytes, word_hashes, word_spans

NULL_KEY = (1 << 63) - 1
#: Members and n-grams of a block, and how many sets' n-grams are compared pair by pair.
MEMBERS, GRAMS, FEW = 1024, 1 << 21, 16
_BLOCKS = (1 << 20) - 1


def banding(threshold: float = 0.8, recall: float = 0.999, far: float = 0.5, most: float = 0.5) -> tuple[int, int]:
    """(bands, rows): the fewest rows with which pairs at ``threshold`` meet with
    probability ``recall``, and pairs at similarity ``far`` with ``most`` at most."""
    for rows in range(1, 64):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)))
        if 1 - (1 - far ** rows) ** bands <= most:
            return bands, rows
    raise ValueError("no banding reaches that recall")


def grams_of(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, after the last, n-gram hashes, bounds) for some texts at a time."""
    for i, j in runs(text_bytes(column)[1], 1 << 21):
        data, bounds = text_bytes(pc.utf8_lower(column.slice(i, j - i).fill_null("")))
        starts, ends, of = word_spans(data, bounds, IS_MARK)
        yield i, j, *ngram_hashes(word_hashes(data, starts, ends), of, n)


def _band_hashes(grams: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For texts that all have n-grams, a row of band hashes each."""
    # the least of a gram's products with odd numbers: each product permutes the 64-bit numbers
    odd = numbers(bands * rows, 11) | np.uint64(1)
    out = np.zeros((len(bounds) - 1, bands), np.uint64)
    fold = numbers(rows, 13) | np.uint64(1)
    for i, j in runs(bounds, 1 << 16):
        part, at = grams[bounds[i]:bounds[j]], bounds[i:j] - bounds[i]
        for band in range(bands):
            for row in range(rows):
                least = np.minimum.reduceat(part * odd[band * rows + row], at)
                out[i:j, band] += mix(least) * fold[row]
    return mix(out + numbers(bands, 17))


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = batch.column("key"), batch.column("tie")
            for i, j, grams, bounds in grams_of(batch.column("text"), n):
                size = np.diff(bounds)
                full = size > 0
                heads = bounds[:-1][full]
                one, two = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                hashes = np.zeros((j - i, bands), np.uint64)
                if len(heads):
                    # order and repetition don't matter to the set, so neither to its hash
                    doc = np.repeat(np.arange(j - i), size)
                    order = np.lexsort((grams, doc))
                    g, d = grams[order], doc[order]
                    once = np.ones(len(g), bool)
                    once[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
                    g, d = g[once], d[once]
                    at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
                    one[full] = np.add.reduceat(mix(g + np.uint64(1)), at)
                    two[full] = np.add.reduceat(mix(g + np.uint64(2)), at)
                    hashes[full] = _band_hashes(grams, np.append(heads, bounds[-1]), bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * bands),
                                                 pa.array(signed(hashes.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [key.slice(i, j - i), tie.slice(i, j - i), pa.array(full), pa.array(signed(one)),
                     pa.array(signed(two)), lists],
                    names=["key", "tie", "full", "set1", "set2", "bands"])
    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, grams, bounds in grams_of(batch.column("text"), n):
                sets = [np.unique(grams[bounds[k]:bounds[k + 1]]) for k in range(j - i)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in ("set1", "set2", "bands")), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(sets))))],
                    names=["set1", "set2", "bands", "n", "grams"])
    return run


def _common(grams: np.ndarray, sizes: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """How many n-grams the first ``rows`` sets have in common with the last ``columns``, for each pair."""
    n, first = len(sizes), len(sizes) - columns
    order = np.argsort(grams, kind="stable")
    g, of = grams[order], np.repeat(np.arange(n), sizes)[order]
    edges = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
    held = np.diff(edges)
    out = np.zeros(rows * columns, np.float32)
    # n-grams of few sets by their pairs
    few = np.repeat((held > 1) & (held <= FEW), held)
    g, some = g[few], of[few]
    for d in range(1, FEW):
        a, b = some[:-d], some[d:]
        both = np.flatnonzero((g[:-d] == g[d:]) & (a < rows) & (b >= first))
        if len(both):
            out += np.bincount(a[both] * columns + b[both] - first, minlength=len(out)).astype(np.float32)
    out = out.reshape(rows, columns)
    # those of many by products of matrices
    many = held > FEW
    of, column = of[np.repeat(many, held)], np.repeat(np.arange(many.sum()), held[many])
    for at in range(0, int(many.sum()), 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        has = np.zeros((n, column[hi - 1] - at + 1), np.float32)
        has[of[lo:hi], column[lo:hi] - at] = 1
        out += has[:rows] @ has[first:].T
    return out


def _near(sizes: np.ndarray, grams: np.ndarray, bands: np.ndarray, band: int, rows: int, columns: int,
          threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The members (i, j) of a cell that reach the threshold and share no earlier band."""
    first = len(sizes) - columns
    common = _common(grams, sizes, rows, columns).astype(np.float64)
    i, j = np.nonzero(common / (sizes[:rows, None] + sizes[first:] - common) >= threshold)
    j += first
    once = i < j   # a block with itself has each pair twice
    i, j = i[once], j[once]
    for b in range(band):
        new = bands[i, b] != bands[j, b]
        i, j = i[new], j[new]
    return i, j


def _least_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each of n members the first that its links lead to."""
    label = np.arange(n)
    while True:
        low, new = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(threshold: float):
    """Over rows sorted by bucket, cell, side and set: (set1, set2, node, other, n_links)
    for the linked members of each cell."""
    def cells(batch: pa.RecordBatch, edges: np.ndarray) -> pa.RecordBatch:
        node, cell, side, band = (batch.column(c).to_numpy() for c in ("node", "cell", "side", "band"))
        sizes = batch.column("n").to_numpy().astype(np.int64)
        grams = batch.column("grams").flatten().to_numpy()
        bands = batch.column("bands").flatten().to_numpy().reshape(len(batch), -1)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        set1, set2 = batch.column("set1").to_numpy(), batch.column("set2").to_numpy()
        found = [(np.zeros(0, np.int64),) * 5]
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            left = int(np.count_nonzero(side[lo:hi] == 0))
            rows, columns = (left, hi - lo - left) if _crosses(int(cell[lo])) else (hi - lo, hi - lo)
            if hi - lo < 2 or not rows or not columns:
                continue
            i, j = _near(sizes[lo:hi], grams[bounds[lo]:bounds[hi]], bands[lo:hi], int(band[lo]), rows, columns,
                         threshold)
            if len(i):
                n_links = np.bincount(np.concatenate((i, j)), minlength=hi - lo)
                linked = np.flatnonzero(n_links)
                other = _least_linked(hi - lo, i, j)[linked]
                found.append((set1[lo + linked], set2[lo + linked], node[lo + linked], node[lo + other], n_links[linked]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)],
                                          names=["set1", "set2", "node", "other", "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None   # the rows of the last cell, which may go on
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not len(batch):
                continue
            bucket, cell = batch.column("bucket").to_numpy(), batch.column("cell").to_numpy()
            edges = np.append(0, np.flatnonzero((bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])) + 1)
            rest = batch.slice(int(edges[-1]))
            if len(edges) > 1:
                yield cells(batch.slice(0, int(edges[-1])), edges)
        if rest is not None:
            yield cells(rest, np.array([0, len(rest)]))
    return run


def _crosses(cell: int) -> bool:
    """Whether a cell (see :func:`_cells`) compares two different blocks."""
    return cell >= 0 and (bool(cell >> 40 & 1) or cell >> 20 & _BLOCKS != cell & _BLOCKS)


def _cells(members: DataFrame, threshold: float) -> DataFrame:
    """The members (set1, set2, node, band, bucket, n) of buckets with the cells and the sides of these they stand in.

    A bucket of at most MEMBERS members and GRAMS n-grams is cell -1. Of others the
    members stand in levels by size: sets that reach the threshold are of one level
    or of two neighbours. A level is cut into blocks by a hash. A cell's number is
    its lower level, whether the other is the next, and the two blocks."""
    # a little more than the greatest ratio of sizes, so rounding can't part a pair by two levels
    width = max(0.01, -1.001 * math.log(threshold))
    members = members.withColumn("level", F.floor(F.log("n") / width).cast("long"))
    levels = members.groupBy("bucket", "level").agg(F.sum("n").alias("grams"), F.count("*").alias("size"))
    blocks = F.greatest(F.ceil(F.col("grams") / GRAMS), F.ceil(F.col("size") / MEMBERS)).cast("long")
    crowded = (levels.groupBy("bucket")
               .agg(F.sum("grams").alias("grams"), F.sum("size").alias("size"),
                    F.map_from_entries(F.collect_list(F.struct("level", blocks.alias("blocks")))).alias("blocks"))
               .where((F.col("grams") > GRAMS) | (F.col("size") > MEMBERS)).select("bucket", "blocks"))
    placed = members.join(crowded, "bucket", "left").withColumn(
        "block", F.expr("pmod(xxhash64(set1), blocks[level])"))
    number = "shiftleft({low} * 2 + {next}, 40) + shiftleft({one}, 20) + {two}"
    own = number.format(low="level", next="0L", one="least(block, x)", two="greatest(block, x)")
    up = number.format(low="level", next="1L", one="block", two="x")
    down = number.format(low="(level - 1)", next="1L", one="x", two="block")

    def with_(level: str, cell: str, side: str) -> str:
        return (f"if(map_contains_key(blocks, {level}), transform(sequence(0L, blocks[{level}] - 1), "
                f"x -> struct({cell} AS cell, {side} AS side)), array())")

    cells = F.expr(f"""CASE WHEN blocks IS NULL THEN array(struct(-1L AS cell, 0 AS side))
        ELSE concat({with_("level", own, "if(block <= x, 0, 1)")}, {with_("level + 1", up, "0")},
                    {with_("level - 1", down, "1")}) END""")
    return placed.select("set1", "set2", "node", "band", "bucket", F.inline(cells))


def links(members: DataFrame, sets: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(set1, set2, node, other, n_links): of the pairs of sets (set1, set2, n, grams, bands)
    that meet in a bucket (set1, set2, node, band, bucket) and reach the threshold. A set has a
    row for each cell in which it has links, with their number there and a node that they lead to."""
    one = ["set1", "set2"]
    rows = _cells(members.join(sets.select(*one, "n"), one), threshold).join(sets, one)
    rows = rows.select("bucket", "cell", "side", *one, "node", "band", "n", "grams", "bands")
    return rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell", "side", *one).mapInArrow(
        _compared(threshold), "set1 bigint, set2 bigint, node bigint, other bigint, n_links bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): for all nodes of the links, the least node of their component.

    Each pass takes the least of the labels of a node, its neighbours, and the
    node that its label names; every pass is written, and counts what it changed."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    labels = materialize(both.groupBy("node").agg(F.min("other").alias("comp"))
                         .select("node", F.least("node", "comp").alias("comp")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("comp").alias("near")))
        named = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        step = labels.join(near, "node").join(named, "comp").select(
            "node", F.least("comp", "near", "far").alias("comp"), (F.least("near", "far") < F.col("comp")).alias("moved"))
        seen = Observation()
        labels = materialize(step.observe(seen, F.count_if("moved").alias("moved")).drop("moved"), "labels")
        if not seen.get["moved"]:
            return labels


def near_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, class_id (the least document id that a chain of links
    or equal sets leads to), n_links (verified links of its n-gram set with
    other sets), n_copies (documents with its n-gram set)."""
    bands, rows = banding(threshold, recall)
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY)).alias("key"),
                        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    signed_ = materialize(keyed.mapInArrow(
        _signatures(n, bands, rows), "key bigint, tie bigint, full boolean, set1 bigint, set2 bigint, bands array<bigint>"),
        "signatures")
    # equal sets have equal bands
    equal = materialize(signed_.where("full").groupBy("set1", "set2")
                        .agg(F.min(F.struct("key", "tie")).alias("least"), F.count("*").alias("n_copies"),
                             F.first("bands").alias("bands"))
                        .select("set1", "set2", "least.tie", F.col("least.key").alias("node"), "n_copies", "bands"),
                        "equal-sets")
    one = ["set1", "set2"]
    placed = materialize(equal.select(*one, "node", F.posexplode("bands").alias("band", "bucket")), "buckets")
    shared = (placed.groupBy("bucket")
              .agg(F.count("*").alias("size"), F.min("band").alias("band"), F.bit_xor(F.xxhash64(*one)).alias("who"),
                   F.bit_xor(F.xxhash64(F.lit(1), *one)).alias("who2")).where("size > 1"))
    # of buckets with the same members the first; the first that a pair shares is always among these
    shared = materialize(shared.groupBy("size", "who", "who2").agg(F.min(F.struct("band", "bucket")).alias("least"))
                         .select("least.bucket"), "shared")
    members = materialize(placed.join(shared, "bucket"), "members")
    wanted = equal.select(*one, "node", "tie", "bands").join(members.select(*one).distinct(), one)
    # rows that repeat are one set; texts that share an id are told apart by their hash
    texts = (keyed.withColumnRenamed("key", "node").join(wanted, ["node", "tie"])
             .select(*one, "bands", "text").dropDuplicates(one))
    sets = materialize(texts.mapInArrow(
        _sets(n), "set1 bigint, set2 bigint, bands array<bigint>, n int, grams array<bigint>"), "sets")

    found = materialize(links(members, sets, threshold), "links")
    comps = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    degree = found.groupBy(*one).agg(F.sum("n_links").alias("n_links"))
    known = materialize(equal.select(*one, "node", "n_copies").join(comps, "node", "left").join(degree, one, "left"),
                        "classes")
    rows_ = (signed_.where("full").select("key", *one).join(known, one)
             .select("key", F.coalesce("comp", "node").alias("class"),
                     F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies"))
    rows_ = rows_.unionByName(signed_.where("NOT full").select(
        "key", F.col("key").alias("class"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies")))
    back = lambda c: F.when(F.col(c) != NULL_KEY, F.col(c))
    return rows_.select(back("key").alias("doc_id"), back("class").alias("class_id"), "n_links", "n_copies")


#: Keys of rows without an id of their own: above all ids that they could meet.
_NO_ID, _NO_ID_BITS = 1 << 62, (1 << 61) - 1


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of each class of near copies, that with the least id; all columns kept.

    A row is known by its id and text. Different texts that share an id, or have none, are
    different documents: they get keys of their own, a hash, for the classes. Rows of the
    same id and text are one.
    """
    key, shared = (fresh(c, docs.columns) for c in ("row_key", "shared_id"))
    texts = docs.select(F.col(doc_id).alias(shared), F.xxhash64(text).alias("tie")).where(F.col(shared).isNotNull())
    several = materialize(texts.groupBy(shared).agg(F.min("tie").alias("a"), F.max("tie").alias("b"))
                          .where("a <> b").select(shared), "shared-ids")
    no_id = F.lit(_NO_ID) + F.xxhash64(F.lit("row"), doc_id, text).bitwiseAND(F.lit(_NO_ID_BITS))
    keyed = docs.join(several, F.col(doc_id) == F.col(shared), "left").withColumn(
        key, F.when(F.col(doc_id).isNull() | F.col(shared).isNotNull(), no_id).otherwise(F.col(doc_id).cast("long")))
    first = fresh("first_key", keyed.columns)
    kept = near_classes(keyed, n, threshold, doc_id=key, text=text).where("doc_id = class_id").select(
        F.col("doc_id").alias(first)).distinct()
    return keyed.join(kept, F.col(key) == F.col(first), "left_semi").dropDuplicates([key]).select(*docs.columns)
