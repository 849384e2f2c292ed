"""Whole columns of text as NumPy arrays: bytes, words, and hashes of spans.

Work goes over pieces of at most ``PIECE`` bytes, so the arrays stay small
however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII other than letters and digits.
IS_MARK = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits of the input."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers by rule."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64(seed * 2 + 1))


@lru_cache(maxsize=4)
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an odd base: a number for each byte, base**i and base**-i for i to PIECE."""
    base = int(numbers(1, seed)[0]) | 1
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(PIECE + 1, base, np.uint64), np.full(PIECE + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return numbers(256, seed + 1), np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class SpanHashes:
    """64-bit hashes of spans of a piece of bytes, by a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        table, up, self._down = _powers(seed)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:len(data)], out=self._sums[1:])

    def raw(self, start, end) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * self._down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) ^ ((end - start).astype(np.uint64) * np.uint64(_GOLD)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 bounds between them; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def runs(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of items that together have at most ``limit``, or of one item."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield i, j
        i = j


def pieces(bounds: np.ndarray, overlap: int) -> Iterator[tuple[int, int, int, int]]:
    """(first document, after the last, start byte, end byte): some whole
    documents, or a part of one that shares ``overlap`` bytes with the next."""
    for i, j in runs(bounds, PIECE):
        start, end = int(bounds[i]), int(bounds[j])
        if end - start <= PIECE:
            yield i, j, start, end
            continue
        while True:
            stop = min(end, start + PIECE)
            yield i, j, start, stop
            if stop == end:
                break
            start = stop - overlap


def word_spans(data: np.ndarray, bounds: np.ndarray,
               outside: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words (runs of bytes that are not ``outside``, as a
    rule ASCII white space), and the bounds of the documents among them."""
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    open_, close = inside.copy(), inside.copy()
    open_[1:] &= ~inside[:-1] | edge[1:-1]
    close[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words; words over a sixteenth of PIECE by BLAKE2."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    long = ends - starts > PIECE // 16
    for k in np.flatnonzero(long):
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    k = np.flatnonzero(~long)
    s, e = starts[k], ends[k]
    at = 0
    while at < len(k):
        to = max(at + 1, int(np.searchsorted(e, s[at] + PIECE, "right")))
        part = SpanHashes(data[s[at]:e[to - 1]], seed)
        out[k[at:to]] = part.of(s[at:to] - s[at], e[at:to] - s[at])
        at = to
    return out


def ngram_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of the words of each document, and their bounds. A
    document of fewer words, but not none, has one: all its words."""
    counts = np.diff(bounds)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    new = np.concatenate(([0], np.cumsum(grams)))
    odd = numbers(n, 77) | np.uint64(1)
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        total += words[i:len(words) - n + 1 + i] * odd[i]
    out = np.zeros(new[-1], np.uint64)
    big = counts >= n
    if big.any():
        at = np.repeat(bounds[:-1][big] - new[:-1][big], grams[big]) + _places(new, big)
        out[_places(new, big)] = total[at]
    for k in np.flatnonzero((counts > 0) & ~big):
        part = words[bounds[k]:bounds[k + 1]]
        out[new[k]] = np.sum(part * odd[:len(part)], dtype=np.uint64) + np.uint64(len(part))
    return mix(out), new


def _places(bounds: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The places of all members of the chosen groups."""
    counts = np.where(chosen, np.diff(bounds), 0)
    return np.flatnonzero(np.repeat(counts > 0, np.diff(bounds)))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as signed numbers, Spark's only long."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
