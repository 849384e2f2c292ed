"""Repeated spans: which occurrence of a string is its first, and cutting out the rest.

An occurrence is one row: two hashes that identify its string, the key of its
document and its place. ``key`` is the document's id (a null id sorts last)
and ``tie`` 20 bits of the text's hash, which tell apart documents that share
an id; identical rows count as one document. A place packs tie, start byte
and ``extra`` (a small number, below 128) into one long, so that the order of
(key, place) is the order of the documents and of the bytes in them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnum import text_bytes

OCCURRENCES = "a bigint, c bigint, key bigint, place bigint, known boolean"
OCCURRENCES_ARROW = pa.schema([("a", pa.int64()), ("c", pa.int64()), ("key", pa.int64()), ("place", pa.int64()),
                               ("known", pa.bool_())])
_START_BITS, _EXTRA_BITS = 36, 7
NULL_KEY = (1 << 63) - 1


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, key, tie and text of the documents."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_KEY)).alias("key"),
                       F.coalesce(F.shiftrightunsigned(F.xxhash64(text), 44), F.lit(0)).alias("tie"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))


def pack(tie: np.ndarray, start: np.ndarray, extra: np.ndarray | int) -> np.ndarray:
    return ((tie.astype(np.int64) << (_START_BITS + _EXTRA_BITS)) | (start.astype(np.int64) << _EXTRA_BITS) | extra)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (place >> (_START_BITS + _EXTRA_BITS), (place >> _EXTRA_BITS) & ((1 << _START_BITS) - 1),
            place & ((1 << _EXTRA_BITS) - 1))


def occurrences(a: np.ndarray, c: np.ndarray, key: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows of a piece of the input. All but the first occurrence of a string in
    it are known to be repeats; they need not meet their string's other
    occurrences, so they are dealt out by a hash of their place."""
    order = np.lexsort((place, key, c, a))
    a, c, key, place = a[order], c[order], key[order], place[order]
    known = np.zeros(len(a), bool)
    if len(a) > 1:
        known[1:] = (a[1:] == a[:-1]) & (c[1:] == c[:-1]) & ((key[1:] != key[:-1]) | (place[1:] != place[:-1]))
    with np.errstate(over="ignore"):
        a = np.where(known, (place + key) * np.int64(0x632BE59BD9B4E019), a)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, c, key, place, known)], schema=OCCURRENCES_ARROW)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by a, c, key, place: the repeats (kind 0), and the first
    occurrences of each (a, c) where an a has several c (kind 1)."""
    first = None   # (a, c, key, place) of the first occurrence of the current string
    alone = None   # it, while no other c of its a was seen
    for batch in batches:
        a, c, key, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        known = batch.column(4).to_numpy(zero_copy_only=False)
        out_key, out_place, out_kind = [key[known]], [place[known]], [np.zeros(int(known.sum()), np.int8)]
        open_ = ~known
        a, c, key, place = a[open_], c[open_], key[open_], place[open_]
        if first is not None:
            a, c, key, place = (np.concatenate(([x], y)) for x, y in zip(first, (a, c, key, place)))
        if len(a):
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
            heads = np.flatnonzero(new)
            head = heads[np.cumsum(new) - 1]
            repeat = (key != key[head]) | (place != place[head])
            ha = a[heads]
            same = ha[1:] == ha[:-1]
            several = np.zeros(len(heads), bool)
            several[1:] |= same
            several[:-1] |= same
            if first is not None and alone is None:
                several[0] = False   # told already
            last_told = several[-1] or (first is not None and alone is None and len(heads) == 1)
            first = tuple(int(x[heads[-1]]) for x in (a, c, key, place))
            alone = None if last_told else first
            chosen = heads[several]
            out_key += [key[repeat], key[chosen]]
            out_place += [place[repeat], place[chosen]]
            out_kind += [np.zeros(int(repeat.sum()), np.int8), np.ones(len(chosen), np.int8)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (out_key, out_place, out_kind)], names=["key", "place", "kind"])


def resolve(rows: DataFrame) -> DataFrame:
    """(key, place, kind): see :func:`_resolve`. One shuffle by the first hash; a
    string of any number of occurrences streams through its task, and each map
    task sent at most one row of it for each piece of its input."""
    return (rows.repartition(F.col("a")).sortWithinPartitions("a", "c", "key", "place")
            .mapInArrow(_resolve, "key bigint, place bigint, kind tinyint"))


def by_document(places: DataFrame) -> DataFrame:
    """(key, tie, places): as many places as a document has, at most."""
    tie = F.shiftright("place", _START_BITS + _EXTRA_BITS)
    return places.groupBy("key", tie.alias("tie")).agg(F.collect_list("place").alias("places"))


def _cut(lengths: Callable[[np.ndarray], np.ndarray], least: int, join_gap: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            places = batch.column("places")
            n_bytes, removed, n_spans, kept, cuts = [], [], [], [], []
            for i in range(len(batch)):
                text = data[bounds[i]:bounds[i + 1]]
                n_bytes.append(len(text))
                if not places[i].is_valid:
                    removed.append(0)
                    n_spans.append(0)
                    kept.append(text.tobytes())
                    cuts.append([])
                    continue
                _, start, extra = unpack(np.unique(places[i].values.to_numpy()))
                end = start + lengths(extra)
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.ones(len(start), bool)
                new[1:] = start[1:] > end[:-1] + join_gap
                s, e = start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                long = (e - s >= least) | (whole & (e - s == len(text)))
                s, e = s[long], e[long]
                mask = np.zeros(len(text) + 1, np.int32)
                np.add.at(mask, s, 1)
                np.add.at(mask, e, -1)
                stay = np.cumsum(mask[:-1]) == 0
                removed.append(int(len(text) - stay.sum()))
                n_spans.append(len(s))
                kept.append(text[stay].tobytes())
                cuts.append([{"start": int(x), "end": int(y)} for x, y in zip(s, e)])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(cuts, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
    return run


def cut(docs: DataFrame, repeats: DataFrame, lengths: Callable[[np.ndarray], np.ndarray],
        least: int = 0, whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans and ``kept``, the remaining bytes:
    of each keyed document less the unions of its repeats that have ``least``
    bytes or, with ``whole``, are all of it. ``lengths`` gives a span's bytes from its place's extra number."""
    kind = dict(docs.dtypes)["doc_id"]
    joined = docs.join(by_document(repeats), ["key", "tie"], "left")
    return joined.mapInArrow(_cut(lengths, least, 0, whole),
                             f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                             "spans array<struct<start: bigint, end: bigint>>, kept binary")
