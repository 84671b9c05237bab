"""Exact k-means over integer vectors with norm-of-sum bounds.

Every vector remembers its distance to each centroid as last computed and the
round of that computation.  A centroid that has moved from c' to c since then is
at least that distance less |c - c'| away, and the own centroid at most that much
farther: the norm of the total displacement, which is never more than the sum of
the moves of the single rounds.  So the centroids of all rounds are kept, k times
the dimensions for each.  Only where these bounds cannot exclude a centroid is its distance
computed again, in integers; ties go to the smaller number.

The vectors with their bounds are a table in the shared folder, rewritten by every
round without a shuffle; a round also leaves one row per task and cluster with
the sums the next centroids are made of.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.session import stored

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = "2"
# Components are integers below this; squared distances then fit 64 bits in up to 64 dimensions.
LARGEST = 1 << 27
# Below this, sums of products are exact in double precision.
EXACT_IN_DOUBLE = 1 << 21
ROWS = 4096

STATE = ("vec_id long, vector binary, cluster int, upper double, upper_round int, lower binary, rounds binary, "
         "distance long, evaluated long, n long, sums array<long>")


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): rows whose embedding has ``dimensions`` finite components, each as floor(scale * x)."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    finite = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    return embeddings.where((F.size("embedding") == dimensions) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.cast("array<long>").alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id, in that order; rows without id are not chosen."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.where("vec_id is not null").select(place.alias("place"), "vector").orderBy("place", "vector")
    return [row["vector"] for row in chosen.limit(clusters).collect()]


def _squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = vectors - centroid
    return np.einsum("ij,ij->i", gap, gap)


def _all_squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) < EXACT_IN_DOUBLE:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([_squared(vectors, c) for c in centroids], axis=1)


def _below(values: np.ndarray) -> np.ndarray:
    """Single precision, rounded down: still a lower bound."""
    near = values.astype(np.float32)
    return np.where(near > values, np.nextafter(near, np.float32(-np.inf)), near)


class Bounds:
    """Assignment, upper bound and the lower bounds of a block of vectors."""

    def __init__(self, cluster, upper, upper_round, lower, rounds):
        self.cluster, self.upper, self.upper_round = cluster, upper, upper_round
        self.lower, self.rounds = lower, rounds

    @classmethod
    def first(cls, vectors: np.ndarray, centroids: np.ndarray) -> "Bounds":
        squared = _all_squared(vectors, centroids)
        cluster = squared.argmin(axis=1)
        distance = np.sqrt(squared.astype(np.float64))
        n = len(vectors)
        return cls(cluster.astype(np.int32), distance[np.arange(n), cluster], np.zeros(n, np.int32),
                   _below(distance), np.zeros(squared.shape, np.int16))

    def advance(self, vectors: np.ndarray, history: list[np.ndarray]) -> int:
        """Assign to the newest centroids; returns how many distances were computed."""
        now, centroids = len(history) - 1, history[-1]
        moved = np.stack([np.sqrt(np.square((centroids - old).astype(np.float64)).sum(axis=1)) for old in history])
        every, k = np.arange(len(vectors)), np.arange(len(centroids))
        # A hair wider on both sides, for rounding.
        least = self.lower - moved[self.rounds, k] * (1 + 1e-9) - 1e-6
        upper = (self.upper + moved[self.upper_round, self.cluster]) * (1 + 1e-9) + 1e-6
        near = least <= upper[:, None]
        near[every, self.cluster] = False
        doubtful = np.flatnonzero(near.any(axis=1))
        if not len(doubtful):
            return 0
        own = self.cluster[doubtful]
        best = _squared(vectors[doubtful], centroids[own])
        exact = np.sqrt(best.astype(np.float64))
        self.upper[doubtful], self.upper_round[doubtful] = exact, now
        self.lower[doubtful, own], self.rounds[doubtful, own] = _below(exact), now
        near = near[doubtful] & (least[doubtful] <= (exact * (1 + 1e-9) + 1e-6)[:, None])
        chosen = own.copy()
        for j in np.flatnonzero(near.any(axis=0)).tolist():
            at = np.flatnonzero(near[:, j])
            squared = _squared(vectors[doubtful[at]], centroids[j])
            distance = np.sqrt(squared.astype(np.float64))
            self.lower[doubtful[at], j], self.rounds[doubtful[at], j] = _below(distance), now
            better = (squared < best[at]) | ((squared == best[at]) & (j < chosen[at]))
            best[at[better]], chosen[at[better]] = squared[better], j
        self.cluster[doubtful], self.upper[doubtful] = chosen, np.sqrt(best.astype(np.float64))
        return len(doubtful) + int(near.sum())


def _fixed(values: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    offsets = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(values), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The matrix behind binary values of one width."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), kind).reshape(len(column), -1)


def _round(history: list[np.ndarray]):
    """One assignment; the first reads arrays of integers, later ones the rows of the round before."""
    centroids = history[-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for whole in batches:
            for batch in (whole.slice(k, ROWS) for k in range(0, whole.num_rows, ROWS)):
                if len(history) == 1:
                    vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                    if np.abs(vectors).max() >= LARGEST:
                        raise ValueError(f"a component is {LARGEST} or more after scaling")
                    bounds, evaluated = Bounds.first(vectors, centroids), vectors.shape[0] * len(centroids)
                else:
                    vectors = _matrix(batch.column("vector"), np.int32).astype(np.int64)
                    bounds = Bounds(*(np.array(batch.column(c).to_numpy()) for c in ("cluster", "upper", "upper_round")),
                                    _matrix(batch.column("lower"), np.float32).copy(),
                                    _matrix(batch.column("rounds"), np.int16).copy())
                    evaluated = bounds.advance(vectors, history)
                distance = _squared(vectors, centroids[bounds.cluster])
                order = np.argsort(bounds.cluster, kind="stable")
                names, first, n = np.unique(bounds.cluster[order], return_index=True, return_counts=True)
                counts[names] += n
                sums[names] += np.add.reduceat(vectors[order], first, axis=0)
                n = len(vectors)
                evaluated = np.append(np.zeros(n - 1, np.int64), evaluated)
                yield _state(batch.column("vec_id"), _fixed(vectors.astype(np.int32)), bounds.cluster, bounds.upper,
                             bounds.upper_round, _fixed(bounds.lower), _fixed(bounds.rounds), distance, evaluated,
                             pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())))
        some = np.flatnonzero(counts)
        if len(some):
            none = [pa.nulls(len(some), f.type) for f in _SCHEMA]
            none[2], none[9], none[10] = some, counts[some], sums[some].tolist()
            yield _state(*none)
    return rows


_SCHEMA = pa.schema([
    ("vec_id", pa.int64()), ("vector", pa.binary()), ("cluster", pa.int32()), ("upper", pa.float64()),
    ("upper_round", pa.int32()), ("lower", pa.binary()), ("rounds", pa.binary()), ("distance", pa.int64()),
    ("evaluated", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


def _state(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _next_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the means; the driver receives one number per cluster and component."""
    totals = (
        state.where("n is not null").select("cluster", "n", F.posexplode("sums").alias("at", "value"))
        .groupBy("cluster", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n")))
    after = centroids.copy()
    for row in totals.collect():
        after[row["cluster"], row["at"]] = row["value"] // row["n"]
    return after


def assign(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """The last assignment (``STATE``) and the centroids after ``rounds`` updates, from (vec_id, array of integers)."""
    history = [np.array(first_centroids(vectors, clusters, seed), np.int64)]
    if not history[0].size:
        return vectors.sparkSession.createDataFrame([], STATE), history[0]
    state = stored(vectors.mapInArrow(_round(history), STATE), "assigned")
    for _ in range(rounds):
        history.append(_next_centroids(state, history[-1]))
        state = stored(state.where("n is null").mapInArrow(_round(history), STATE), "assigned")
    return state, history[-1]


def cluster(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: int = SCALE, seed: str = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that is kept.

    Kept are rows of ``embeddings`` (vec_id, embedding, ...) with exactly ``dimensions`` components, none null or not
    finite.  A repeated vec_id is a row each time; a row without vec_id is clustered, but is no first centroid.  With
    fewer than ``clusters`` vectors each is a centroid; without any there is no row.  Equal first centroids stay
    apart: the later ones are empty and keep their place.  A component of 2**27 or more after scaling is an error.
    Other columns are not read.
    """
    spark = embeddings.sparkSession
    state, centroids = assign(integer_vectors(embeddings, dimensions, scale), clusters, rounds, seed)
    points = state.where("n is null").select("vec_id", "cluster", "distance")
    per_cluster = {row["cluster"]: row["total"] for row in points.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    names = spark.createDataFrame(
        [(k, ",".join(map(str, c)), per_cluster.get(k, 0), sum(per_cluster.values()))
         for k, c in enumerate(centroids.tolist())],
        "cluster int, components string, cluster_inertia long, inertia long")
    digest: Column = F.sha2("components", 256).alias("centroid_sha256")
    # One row per cluster: the size of this side is a parameter.
    return points.join(F.broadcast(names.select("cluster", "cluster_inertia", "inertia", digest)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
