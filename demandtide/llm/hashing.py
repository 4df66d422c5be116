"""Words and shingles of many texts as 64-bit hashes, vectorized over a batch's bytes.

A word's hash is a polynomial over its bytes, taken from running sums modulo 2**64: the bytes map
to fixed random numbers, the base is odd and so has an inverse. No text becomes a Python string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK = 1 << 21

BASE = 0x9E3779B97F4A7C15
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


class Tables:
    """Byte values, powers of the base and of its inverse, up to the longest chunk seen."""

    def __init__(self) -> None:
        self.value = numbers(256, 1)
        upper = np.arange(65, 91)
        self.value[upper] = self.value[upper + 32]
        self.space = np.zeros(256, dtype=bool)
        self.space[list(_SPACES)] = True
        self.grow(CHUNK)

    def grow(self, n: int) -> None:
        self.length = n
        self.power = self._powers(BASE, n)
        self.inverse = self._powers(pow(BASE, -1, 1 << 64), n)

    @staticmethod
    def _powers(x: int, n: int) -> np.ndarray:
        out = np.full(n + 1, x, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (len + 1) of a string column; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``CHUNK`` bytes, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (between ASCII white space, A-Z lower-cased) of adjacent texts, and the
    first word of each text (one more at the end). ``offsets`` are those of the texts in ``data``."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    b, offsets = data[lo:hi], offsets - lo
    if hi == lo:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if len(b) > tables.length:
        tables.grow(len(b))
    inside = ~tables.space[b]
    edge = np.zeros(len(b) + 1, dtype=bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(tables.value[b] * tables.power[: len(b)], out=total[1:])
    return mix((total[e] - total[s]) * tables.inverse[s] + (e - s).astype(np.uint64)), np.searchsorted(s, offsets)


def shingle_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on (len - n + 1 of them)."""
    c = numbers(n, 7 + n) | np.uint64(1)
    out = np.zeros(max(0, len(w) - n + 1), dtype=np.uint64)
    for k in range(n):
        out += w[k : k + len(out)] * c[k]
    return mix(out + np.uint64(n))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def shingle_sets(column: pa.Array, n: int, tables: Tables) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text; a text of fewer words is one shingle, one
    without words has none."""
    data, offsets = text_buffers(column)
    for i, j in chunks(offsets):
        w, first = word_hashes(data, offsets[i : j + 1], tables)
        all_of = shingle_hashes(w, n)
        for k in range(j - i):
            a, z = int(first[k]), int(first[k + 1])
            if z - a >= n:
                yield i + k, distinct(all_of[a : z - n + 1])
            elif z > a:
                yield i + k, shingle_hashes(w[a:z], z - a)
            else:
                yield i + k, np.zeros(0, np.uint64)
