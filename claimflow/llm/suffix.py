"""Repeated windows by depth-limited radix sort of suffixes (operator 6).

Suffixes are ordered only through ``length`` bytes, in passes from the most
significant digit on; a digit is a hash of the bytes it covers, and after each
pass a group of one leaves the sort, since it cannot repeat.

1. A first digit of 32 bytes. Sorting a suffix at every byte would move many
   times the input, so a window stands for its suffix at the smallest hash of
   a gram of that many bytes in it (the leftmost of equals): equal windows
   choose the same one. All neighbouring windows with one choice travel as a
   single row, with a hash of the whole context that they cover. Rows with
   gram and context of an earlier row repeat that row's windows one by one;
   a gram with one context is done.
2. The first row of each context of the remaining grams goes through the same
   pass with a longer digit, 84 bytes.
3. The last digit are the ``length`` bytes of each single window that is left.
   Equal groups are exactly the repeated windows.

Every window but the first of its group, in the order of document id and
place, is a repeat; a document loses the bytes that its repeats cover.

Null and empty texts, and texts shorter than ``length``, have no windows.
Documents that share an id are ordered by a hash of their texts; identical
rows are one document, and each comes out like it. A null id sorts last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import materialize
from .textnum import SpanHashes, mix, pieces, signed, text_bytes

#: Bytes of the digits before the last.
DIGITS = (32, 84)
#: The low bits of a packed gram hash hold its place: PIECE needs 21.
_PLACE = np.uint64((1 << 21) - 1)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    if width < n:
        x = np.minimum(x[:len(x) - (n - width)], x[n - width:])
    return x


def _windows(bounds: np.ndarray, i: int, j: int, start: int, end: int, length: int) -> np.ndarray:
    """Starts of the windows within one document, relative to ``start``."""
    inner = np.clip(bounds[i:j + 1], start, end) - start
    mark = np.zeros(end - start + 1, np.int32)
    long = np.diff(inner) >= length
    mark[inner[:-1][long]] += 1
    mark[inner[1:][long] - length + 1] -= 1
    return np.flatnonzero(np.cumsum(mark))


def choices(data: np.ndarray, at: np.ndarray, length: int, digit: int) -> tuple[np.ndarray, ...]:
    """First and last start of the runs of the windows ``at`` that choose one gram
    of ``digit`` bytes, and the hashes of gram and context."""
    hashes = SpanHashes(data)
    grams = np.arange(len(data) - digit + 1)
    h = mix(hashes.raw(grams, grams + digit))
    packed = (h & ~_PLACE) | grams.astype(np.uint64)
    chosen = (_least(packed, length - digit + 1)[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    s, e, anchor = at[first], at[last], chosen[first]
    context = mix(hashes.of(s, e + length) ^ (anchor - s).astype(np.uint64))
    return s, e, h[anchor], context


def _all(length: int, digit: int):
    """The first pass, over every window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = (batch.column(n).to_numpy() for n in ("key", "tie"))
            data, bounds = text_bytes(batch.column("text"))
            for i, j, start, end in pieces(bounds, length - 1):
                at = _windows(bounds, i, j, start, end, length)
                if not len(at):
                    continue
                s, e, gram, context = choices(data[start:end], at, length, digit)
                doc = np.searchsorted(bounds, s + start, "right") - 1
                place = spans.pack(tie[doc], s + start - bounds[doc], e - s)
                yield spans.occurrences(signed(gram), signed(context), key[doc], place)
    return run


def _listed(length: int, digit: int | None):
    """A later pass, over the windows of the listed places of each document;
    without a digit the last one, with a row for each window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = (batch.column(n).to_numpy() for n in ("key", "tie"))
            data, bounds = text_bytes(batch.column("text"))
            places = batch.column("places")
            parts, size = [], 0
            for i in range(len(batch)):
                _, start, more = spans.unpack(np.unique(places[i].values.to_numpy()))
                at = np.unique(np.repeat(start - np.cumsum(more + 1) + more + 1, more + 1)
                               + np.arange(int((more + 1).sum())))
                text = data[bounds[i]:bounds[i + 1]]
                for _, _, lo, hi in pieces(np.array([0, len(text)]), length - 1):
                    here = at[(at >= lo) & (at <= hi - length)] - lo
                    if not len(here):
                        continue
                    if digit:
                        s, e, a, c = choices(text[lo:hi], here, length, digit)
                    else:
                        one, two = SpanHashes(text[lo:hi]), SpanHashes(text[lo:hi], 8)
                        s = e = here
                        a, c = (x.of(here, here + length) for x in (one, two))
                    parts.append((signed(a), signed(c), np.full(len(s), key[i]),
                                  spans.pack(np.full(len(s), tie[i]), s + lo, e - s)))
                    size += len(s)
                    if size >= 50_000:
                        yield spans.occurrences(*(np.concatenate(x) for x in zip(*parts)))
                        parts, size = [], 0
            if parts:
                yield spans.occurrences(*(np.concatenate(x) for x in zip(*parts)))
    return run


def repeated_windows(docs: DataFrame, length: int = 100, digits: tuple[int, ...] = DIGITS) -> DataFrame:
    """(key, place): runs of repeated windows of :func:`spans.keyed` documents; a
    place's extra number is the count of windows after its first."""
    digits = tuple(d for d in digits if d < length)
    if not digits or length - digits[0] > 127:
        raise ValueError("a digit below the length, and by at most 127 bytes, is needed")
    passed = materialize(spans.resolve(docs.mapInArrow(_all(length, digits[0]), spans.OCCURRENCES)), "suffix-pass")
    repeats = passed.where("kind = 0").select("key", "place")
    for digit in (*digits[1:], None):
        left = spans.by_document(passed.where("kind = 1"))
        # each pass and the final cut read the same shuffle of the texts
        rows = docs.join(left, ["key", "tie"]).mapInArrow(_listed(length, digit), spans.OCCURRENCES)
        passed = spans.resolve(rows)
        repeats = repeats.unionByName(passed.where("kind = 0").select("key", "place"))
    return repeats


def remove_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans, kept (the remaining bytes)."""
    d = spans.keyed(docs, doc_id, text)
    return spans.cut(d, repeated_windows(d, length), lambda more: more + length)
