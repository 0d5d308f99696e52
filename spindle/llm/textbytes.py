"""Vectorised work on the UTF-8 bytes of Arrow string batches, for use inside
Spark tasks: word bounds, hashes of any byte range, runs of numbers.

A batch is handled in slices of a bounded number of bytes (at least one row),
so memory follows the slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
U = np.uint64
# Odd multipliers of the two polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def column_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of successive slices of a string
    column; null texts are empty. offsets[i] is where row `first + i` starts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def class_table(separators: list[int]) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[separators] = False
    return t


LOWER = lower_table()
SPACES = class_table([0x20, *range(0x09, 0x0E)])
ALNUM = class_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (maximal runs of `inside` bytes within a
    row) and, for each row, the index of its first word (one more at the end)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    mask = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:n]
    last = mask.copy()
    last[:-1] &= ~mask[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Ranges:
    """Hashes of arbitrary byte ranges of one slice: polynomial prefix sums
    modulo 2**64, scaled so that equal ranges hash alike wherever they stand."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, SLICE + 4096)
            up = np.full(size, base, dtype=np.uint64)
            up[0] = 1
            down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
            down[0] = 1
            have = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
            if size <= 8 * SLICE:  # a huge text does not stay in memory
                cls._powers[base] = have
        return have

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        up, self.down = self.powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + U(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def fixed(self, width: int) -> np.ndarray:
        """Hashes of all ranges of one width."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, np.uint64)


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def interval_cover(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint, maximal intervals that cover the given ones."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], np.append(e[at[1:] - 1], e[-1])
