"""Anchors: sampled suffixes that equal long strings choose alike, found in numpy over blocks of bytes.

Of every window of ``length`` bytes the anchor is the leftmost position whose
``gram`` bytes have the smallest hash.  The choice depends on the window alone,
so equal windows have their anchor at the same place.  The windows of one anchor
are neighbours; together they cover its segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from martloom.llm.textbytes import blocks, mix

# Windows that are taken at once; a longer text is cut into pieces that overlap by a window.
PIECE = 1 << 18

_BASE = 0x5851F42D4C957F2D
_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64."""
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Hashes:
    """64-bit hashes of all substrings of a block of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(1 << max(len(data) - 1, 1).bit_length())
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * up[:len(data)], dtype=np.uint64, out=self.sums[1:])

    def spans(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.down[first])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the position of its smallest, the leftmost of equal ones.

    Each window is the end of one run of ``width`` values and the beginning of the next.
    """
    n = len(values)
    runs = -(-n // width)
    table = np.full(runs * width, np.iinfo(np.uint64).max, np.uint64)
    table[:n] = values
    table = table.reshape(runs, width)
    place = np.arange(width, dtype=np.int32)
    start = (np.arange(runs, dtype=np.int64) * width)[:, None]

    ahead = np.minimum.accumulate(table, axis=1)
    fresh = np.ones(table.shape, bool)
    fresh[:, 1:] = table[:, 1:] < ahead[:, :-1]
    ahead_at = (np.maximum.accumulate(np.where(fresh, place, 0), axis=1) + start).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)
    met = np.maximum.accumulate(np.where(table[:, ::-1] == back, place, 0), axis=1)
    back_at = ((width - 1 - met) + start)[:, ::-1].ravel()

    ahead, back = ahead.ravel(), back[:, ::-1].ravel()
    windows = n - width + 1
    left = back[:windows] <= ahead[width - 1:width - 1 + windows]
    return np.where(left, back_at[:windows], ahead_at[width - 1:width - 1 + windows])


@dataclass
class Anchors:
    """One entry per anchor: its row, and positions in the block of the anchor and of its first and last window."""

    row: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray
    segment: np.ndarray


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Anchors | None:
    """The anchors of all windows that lie inside one row."""
    windows = len(data) - length + 1
    if windows <= 0:
        return None
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    at = leftmost_minima(grams, length - gram + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    inside = offsets[1:][row] - np.arange(windows) >= length
    low = inside.copy()
    low[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    high = inside.copy()
    high[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
    low, high = np.flatnonzero(low), np.flatnonzero(high)
    at = at[low]
    whole = hashes.spans(low, high + length) + ((at - low) * 4096 + high - low).astype(np.uint64)
    return Anchors(row[low], at, low, high, grams[at], mix(whole))


def pieces(column: pa.Array, length: int, most: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, its first byte, bytes, offsets) of runs of rows, and of overlapping pieces of longer rows.

    Every window of ``length`` bytes lies in exactly one piece.
    """
    for first, end, data, offsets in blocks(column, most):
        if len(data) <= most + length:
            yield first, 0, data, offsets
            continue
        for at in range(0, len(data), most):
            part = data[at:at + most + length - 1]
            yield first, at, part, np.array([0, len(part)], np.int64)
