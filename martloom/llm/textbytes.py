"""Vectorised helpers over Arrow text columns: byte buffers, spans of bytes, 64-bit hashes, shingle sets."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Texts are taken through numpy in blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(20240502).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def giving_back(rows: Callable) -> Callable:
    """A function of Arrow batches that returns its freed memory to the system: Python workers live on between tasks."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return wrapped


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without a copy, and the n + 1 offsets; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of successive runs of rows with about ``most`` bytes."""
    data, offsets = buffer_of(column)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def spans(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; a run also ends at every position in ``breaks``."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    at = breaks[(breaks > 0) & (breaks < len(inside))]
    begins[at] = inside[at]
    stops[at - 1] |= inside[at - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


# Bytes of a piece of a long span.
LONG_SPAN = 256


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span.

    Spans of up to ``LONG_SPAN`` bytes advance byte by byte together.  A longer one is the sum of the hashes of its
    pieces, each times a power of its place, so one word of many megabytes costs no more steps than a short one.
    """
    length = ends - starts
    long = np.flatnonzero(length > LONG_SPAN)
    if not len(long):
        return _hash_short(data, starts, ends)
    count = -(-length[long] // LONG_SPAN)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    place = np.arange(int(count.sum())) - np.repeat(first, count)
    begin = np.repeat(starts[long], count) + place * LONG_SPAN
    pieces = _hash_short(data, begin, np.minimum(begin + LONG_SPAN, np.repeat(ends[long], count)))
    power = np.multiply.accumulate(np.full(int(count.max()), _STEP, np.uint64))
    short = length <= LONG_SPAN
    h = np.empty(len(length), np.uint64)
    h[short] = _hash_short(data, starts[short], ends[short])
    h[long] = mix(np.add.reduceat(pieces * power[place], first) + length[long].astype(np.uint64))
    return h


def _hash_short(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All spans advanced byte by byte together: as many steps as the longest has bytes."""
    length = ends - starts
    h = length.astype(np.uint64)
    live = np.flatnonzero(length > 0)
    at = 0
    while len(live):
        v = (h[live] + _BYTE_CODE[data[starts[live] + at]]) * _STEP
        h[live] = v ^ (v >> np.uint64(32))
        at += 1
        live = live[length[live] > at]
    return mix(h)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each row the index of its first word (n + 1 entries)."""
    starts, ends = spans(~SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For every row the sorted distinct hashes of its word shingles.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A
    row with fewer than ``width`` words has its whole sequence as one shingle,
    a row without words the empty set.
    """
    data = LOWER[data]
    starts, ends, first = words_of(data, offsets)
    word = hash_spans(data, starts, ends)
    n = len(word)
    grams = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        grams += word[k:k + len(grams)] * _PLACE[k]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            s = np.sort(grams[a:b - width + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            few = (word[a:b] * _PLACE[8:8 + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes:
    """A 128-bit fingerprint of a sorted set of hashes."""
    if not len(s):
        return b""
    other = mix(s * _PLACE[20] + _PLACE[21])
    parts = np.array([mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(other)], np.uint64)
    return parts.tobytes()
