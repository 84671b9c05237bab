"""Bloom filters built on executors: bit blocks are merged by block, not by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.session import merging

PROBES = 4
CHUNK_BYTES = 1 << 15
# Broadcast bound: a filter never takes more than this, however large the corpus.
MAX_BYTES = 32 << 20


def filter_bytes(rows: int, bits_per_row: int = 16, max_bytes: int = MAX_BYTES) -> int:
    """A power of two of bytes for ``rows`` entries, at least one chunk and at most ``max_bytes``.

    Beyond the bound the filter only becomes less selective, never wrong.
    """
    wanted = max(rows * bits_per_row // 8, CHUNK_BYTES)
    return min(1 << (wanted - 1).bit_length(), max_bytes)


def bit_positions(h: np.ndarray, n_bytes: int) -> np.ndarray:
    """(n, PROBES) bit positions of 64-bit hashes."""
    h = h.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    probes = h[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)[None, :]
    return ((probes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(n_bytes * 8)


def test(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True where all probes of a hash are set."""
    at = bit_positions(h, len(bits))
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def put(bits: np.ndarray, h: np.ndarray) -> None:
    at = bit_positions(h, len(bits)).ravel()
    np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def _chunks(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(once), CHUNK_BYTES):
        part = once[k:k + CHUNK_BYTES]
        if part.any():
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([k // CHUNK_BYTES], pa.int32()),
                "once": pa.array([part.tobytes()], pa.binary()),
                "twice": pa.array([twice[k:k + CHUNK_BYTES].tobytes()], pa.binary())})


def hash_filters(hashes: DataFrame, column: str, n_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, twice): the filter of all hashes, and of those that may occur more than once.

    Each task fills filters of its own rows; the tasks' filters meet chunk by
    chunk, where a bit set by two tasks goes to ``twice``.  A hash in two rows
    therefore has all its bits in ``twice``; the reverse can be false.  The
    driver receives the two merged filters, at most twice ``n_bytes``.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(n_bytes, np.uint8), np.zeros(n_bytes, np.uint8)
        for batch in batches:
            h = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            h, n = np.unique(h, return_counts=True)
            put(twice, h[(n > 1) | test(once, h)])
            # Bits shared by different hashes of one task need not go to twice: each hash was tested whole.
            put(once, h)
        yield from _chunks(once, twice)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for chunk, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if chunk in held:
                    once, twice = held[chunk]
                    twice |= b | (once & a)
                    once |= a
                else:
                    held[chunk] = a.copy(), b.copy()
        for chunk, (once, twice) in held.items():
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([chunk], pa.int32()), "once": pa.array([once.tobytes()], pa.binary()),
                "twice": pa.array([twice.tobytes()], pa.binary())})

    schema = "chunk int, once binary, twice binary"
    merged = (
        hashes.select(F.col(column).cast("long")).mapInArrow(fill, schema)
        .repartition("chunk").mapInArrow(merge, schema))
    once, twice = np.zeros(n_bytes, np.uint8), np.zeros(n_bytes, np.uint8)
    # Bounded: at most twice n_bytes.  One job, where a local iterator would run one for every partition.
    for row in merged.collect():
        at = row["chunk"] * CHUNK_BYTES
        once[at:at + CHUNK_BYTES] = np.frombuffer(row["once"], np.uint8)
        twice[at:at + CHUNK_BYTES] = np.frombuffer(row["twice"], np.uint8)
    return once, twice


def maybe_in(bits: np.ndarray, code: Column) -> Column:
    """True where a 64-bit hash may be in the filter; only the hash goes through Python."""

    @F.pandas_udf("boolean")
    def tested(codes: pd.Series) -> pd.Series:
        return pd.Series(test(bits, codes.to_numpy(dtype=np.int64).view(np.uint64)))

    return tested(code)


def anti_join(rows: DataFrame, key: str, gone: DataFrame, gone_key: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``rows`` whose key is not in ``gone``: rows outside a filter of its keys pass without a shuffle.

    Both keys have one type.  A null key equals a null key, and every row of a key goes, so the key must name
    what was decided on.  ``gone`` is read several times and should be stored.
    """
    bits, _ = hash_filters(
        gone.select(F.xxhash64(gone_key).alias("code")), "code", filter_bytes(gone.count(), max_bytes=max_bytes))
    flag = "__may_be_gone"
    tested = rows.withColumn(flag, maybe_in(bits, F.xxhash64(key)))
    sure = tested.where(~F.col(flag)).drop(flag)
    doubtful = tested.where(flag).drop(flag)
    return sure.unionByName(doubtful.join(merging(gone), F.col(key).eqNullSafe(F.col(gone_key)), "left_anti"))
