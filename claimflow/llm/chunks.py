"""Substring deduplication by content-defined chunks (operator 10).

A gear hash rolls over the bytes of a text: at each byte it is shifted left
by one and the byte's random number added, so its top bits depend on the last
32 bytes only. A chunk ends where those bits are zero, at ``least`` bytes or
more, or at ``most``. An insertion shifts the ends near it and no others.

A chunk whose digest stands earlier, in the order of document id and place,
is a repeat. Neighbouring repeats that together have ``span`` bytes or more
are removed, with ``whole`` also those of any length that make up their whole
document; other short ones, common phrases, stay.

Null and empty texts have no chunks. Documents that share an id are ordered
by a hash of their texts; identical rows are one document, and each comes out
like it. A null id sorts last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import spans
from .textnum import SpanHashes, numbers, pieces, signed, text_bytes

#: Bytes that the gear hash depends on: the bits of its numbers.
WINDOW = 32
#: Chunks end on average after 2**BITS candidates.
BITS = 4
LEAST, MOST = 20, 96
SPAN = 96

_GEAR = (numbers(256, 5) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling: 32 terms in five steps."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def chunk_ends(data: np.ndarray, least: int = LEAST, most: int = MOST, bits: int = BITS) -> list[int]:
    """Ends of the chunks of one text."""
    ends, last, n = [], 0, len(data)
    for _, _, lo, hi in pieces(np.array([0, n]), WINDOW):
        skip = WINDOW if lo else 0   # judged in the piece before, where the whole window stood
        found = np.flatnonzero(gear(data[lo:hi]) >> np.uint32(32 - bits) == 0)
        for end in (found[found >= skip] + lo + 1).tolist():
            size = end - last
            while size > most:
                last += most
                ends.append(last)
                size -= most
            if size >= least:
                ends.append(end)
                last = end
    while n - last > most:
        last += most
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _chunks(least: int, most: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tie = (batch.column(n).to_numpy() for n in ("key", "tie"))
            data, bounds = text_bytes(batch.column("text"))
            parts, size = [], 0
            for i in range(len(batch)):
                text = data[bounds[i]:bounds[i + 1]]
                ends = np.array(chunk_ends(text, least, most, bits), np.int64)
                starts = np.concatenate(([0], ends[:-1]))[:len(ends)]
                for lo, hi in _groups(starts, ends):
                    s, e = starts[lo:hi], ends[lo:hi]
                    part = text[s[0]:e[-1]]
                    one, two = SpanHashes(part), SpanHashes(part, 8)
                    parts.append((signed(one.of(s - s[0], e - s[0])), signed(two.of(s - s[0], e - s[0])),
                                  np.full(len(s), key[i]), spans.pack(np.full(len(s), tie[i]), s, e - s)))
                    size += len(s)
                    if size >= 50_000:
                        yield spans.occurrences(*(np.concatenate(x) for x in zip(*parts)))
                        parts, size = [], 0
            if parts:
                yield spans.occurrences(*(np.concatenate(x) for x in zip(*parts)))
    return run


def _groups(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of chunks within a piece's bytes."""
    lo = 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + (1 << 20), "right")))
        yield lo, hi
        lo = hi


def repeated_chunks(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """(key, place): the chunks of :func:`spans.keyed` documents that repeat an
    earlier one; a place's extra number is the chunk's bytes."""
    if not 0 < least <= most < 128:
        raise ValueError("chunks have 1 to 127 bytes")
    rows = docs.mapInArrow(_chunks(least, most, bits), spans.OCCURRENCES)
    return spans.resolve(rows).where("kind = 0").select("key", "place")


def remove_repeats(docs: DataFrame, least: int = LEAST, most: int = MOST, bits: int = BITS, span: int = SPAN,
                   doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans, kept (the remaining bytes)."""
    d = spans.keyed(docs, doc_id, text)
    return spans.cut(d, repeated_chunks(d, least, most, bits), lambda size: size, least=span, whole=whole)
