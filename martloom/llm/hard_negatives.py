"""Hard negatives by rotated one-bit codes with exact intervals.

A vector, less the centre of its block, is turned by a random rotation and only
the signs of its components are kept: one bit each.  Stored with the code is its
alignment, the vector's inner product with the code's direction, so what the code
leaves out is known and has a known length; that rest is coded the same way, a few
times.  A query is rotated too and rounded to eight bits; its inner product with a
code is then a few popcounts, one for each bit plane.

For every row this gives an estimate of the score and, by Cauchy-Schwarz, an
interval that surely holds it: the length of the last rest times the query's, and
the query's rounding error.  Rows whose interval cannot reach the wanted ranks or
the wanted band are left out; all others are scored in integers.

Rows lie in blocks of one label and bounded size.  Blocks of queries meet blocks of
rows through equi-joins on block numbers; what a task hands on is its best few rows
per query, and the ranks among all are found by windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.session import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
# Rows and queries of a block.
ROWS, QUERIES = 8192, 256
# Codes of one vector, each of what the one before left out.
STAGES = 4
PLANES = 8
# Row blocks that one task compares with the same queries, and groups the query blocks are dealt into at most.
SLOT_BLOCKS, QUERY_GROUPS = 32, 16
LARGEST = 1 << 24


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of rows with an id, a label and a vector of finite components."""
    finite = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))


@lru_cache(maxsize=8)
def _rotations(dimensions: int) -> list[np.ndarray]:
    random = np.random.default_rng([20240701, dimensions])
    if not dimensions:
        return []
    return [np.linalg.qr(random.normal(size=(dimensions, dimensions)))[0] for _ in range(STAGES)]


def _bits(signs: np.ndarray) -> np.ndarray:
    """(words, n) of 64 bits from an (n, dimensions) matrix of truth values."""
    n, d = signs.shape
    wide = np.zeros((n, -(-d // 64) * 64), bool)
    wide[:, :d] = signs
    return np.ascontiguousarray(np.packbits(wide, axis=1, bitorder="little").view(np.uint64).T)


class Codes:
    """A block of vectors with their codes around the block's centre, as ``coded`` stores them."""

    def __init__(self, row: dict):
        n = row["size"]
        self.dimensions = len(row["vectors"]) // (4 * n)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, self.dimensions)
        self.centre, self.rest, self.slack = (np.frombuffer(row[c], np.float64) for c in ("centre", "rest", "slack"))
        self.alignment = np.frombuffer(row["alignment"], np.float64).reshape(len(_rotations(self.dimensions)), n)
        self.bits = np.frombuffer(row["bits"], np.uint64).reshape(len(self.alignment), -(-self.dimensions // 64), n)
        self.ones = [_ones(b) for b in self.bits]

    def interval(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products of all rows with a query of integers."""
        turned = query.astype(np.float64)
        length = float(np.sqrt(turned @ turned))
        middle = np.full(len(self.vectors), self.centre @ turned)
        half = self.rest * length + self.slack * (1 + length)
        for rotation, bits, ones, along in zip(_rotations(self.dimensions), self.bits, self.ones, self.alignment):
            turned = rotation @ turned
            step = max(float(np.abs(turned).max()), 1e-300) / ((1 << (PLANES - 1)) - 1)
            whole = np.rint(turned / step).astype(np.int64)
            shifted = whole + (1 << (PLANES - 1))
            total = np.zeros(len(self.vectors), np.int32)
            masks = _bits((shifted >> np.arange(PLANES)[:, None] & 1).astype(bool))
            for plane in range(PLANES):
                total += _ones(bits & masks[:, plane, None]) * np.int32(1 << plane)
            # The sum over set bits, twice, less the sum over all: the inner product with the signs.
            signed = 2 * (total - ones * (1 << (PLANES - 1))) - whole.sum()
            middle += along * step * signed
            gap = turned - step * whole
            half += along * np.sqrt(self.dimensions * (gap @ gap))
        return middle - half, middle + half

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows].astype(np.int64) @ query


def _ones(bits: np.ndarray) -> np.ndarray:
    """Set bits of the (words, n) codes."""
    counts = np.bitwise_count(bits)
    return counts[0].astype(np.int32) if len(counts) == 1 else counts.sum(axis=0, dtype=np.int32)


CODED = "centre binary, alignment binary, bits binary, rest binary, slack binary"


def coded(vectors: np.ndarray) -> dict[str, bytes]:
    """The columns of ``CODED`` for a block of vectors."""
    exact = vectors.astype(np.float64)
    centre = exact.mean(axis=0)
    rest, bits, alignment = exact - centre, [], []
    for rotation in _rotations(vectors.shape[1]):
        rest = rest @ rotation.T
        sign = rest >= 0
        along = np.abs(rest).sum(axis=1) / vectors.shape[1]
        rest = rest - np.where(sign, along[:, None], -along[:, None])
        bits.append(_bits(sign))
        alignment.append(along)
    slack = 1e-9 * (1 + np.abs(centre).sum() + np.sqrt((exact * exact).sum(axis=1)))
    return {"centre": centre.tobytes(), "alignment": b"".join(a.tobytes() for a in alignment),
            "bits": b"".join(b.tobytes() for b in bits), "rest": np.sqrt((rest * rest).sum(axis=1)).tobytes(),
            "slack": slack.tobytes()}


def _packed(column, kind=np.int64) -> bytes:
    return np.ascontiguousarray(column, kind).tobytes()


def _vectors(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.floor(SCALE * flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    values = values.reshape(n, len(values) // n)
    if np.abs(values).max(initial=0) >= LARGEST:
        raise ValueError(f"a component is {LARGEST} or more after scaling")
    return values.astype(np.int32)


BLOCK = "numbers binary, ids binary, labels binary, vectors binary, size long"


def _pack(extra: list[str]):
    """A group of rows as one row of binary columns."""
    def pack(table: pa.Table) -> pa.Table:
        n = table.num_rows
        columns = {c: table.column(c).slice(0, 1) for c in extra}
        columns |= {
            "numbers": pa.array([_packed(table.column("number").to_numpy())]),
            "ids": pa.array([_packed(table.column("vec_id").to_numpy())]),
            "labels": pa.array([_packed(table.column("label").to_numpy())]),
            "vectors": pa.array([_vectors(table.column("embedding"), n).tobytes()]),
            "size": pa.array([n], pa.int64())}
        return pa.table(columns)
    return pack


def _pack_coded(extra: list[str]):
    """The same with the codes of the rows."""
    pack = _pack(extra)

    def pack_coded(table: pa.Table) -> pa.Table:
        packed = pack(table)
        vectors = np.frombuffer(packed.column("vectors")[0].as_py(), np.int32)
        vectors = vectors.reshape(table.num_rows, len(vectors) // table.num_rows)
        for name, column in coded(vectors).items():
            packed = packed.append_column(name, pa.array([column], pa.binary()))
        return packed
    return pack_coded


def _pack_queries(table: pa.Table) -> pa.Table:
    """Queries with the scores of their positives, which are padded to one width."""
    n = table.num_rows
    found = table.column("scores").to_pylist()
    wide = np.full((n, max(map(len, found))), np.iinfo(np.int64).min, np.int64)
    for k, scores in enumerate(found):
        wide[k, :len(scores)] = sorted(scores, reverse=True)
    packed = _pack(["dimensions", "query_block"])(table)
    return packed.append_column("scores", pa.array([wide.tobytes()]))


class _Reader:
    """Codes of row blocks by their number, the last one kept: neighbours in a batch share it."""

    def __init__(self):
        self.name, self.codes = None, None

    def __call__(self, row: dict) -> Codes:
        if self.name != row["block"]:
            self.name, self.codes = row["block"], Codes(row)
        return self.codes


def _best(scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((numbers, ids, -scores))[:most]


def _positive_rows(most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _Reader()
        for batch in batches:
            for row in batch.to_pylist():
                codes = read(row)
                ids, numbers, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "numbers", "labels"))
                asked = np.frombuffer(row["q_vectors"], np.int32).reshape(row["q_size"], codes.dimensions).astype(np.int64)
                out: list[tuple] = []
                for query, number, label in zip(asked, np.frombuffer(row["q_numbers"], np.int64),
                                                np.frombuffer(row["q_labels"], np.int64)):
                    mine = np.flatnonzero((labels == label) & (numbers != number))
                    if not len(mine):
                        continue
                    low, high = codes.interval(query)
                    if len(mine) > most:
                        mine = mine[high[mine] >= np.partition(low[mine], -most)[-most]]
                    scores = codes.scores(query, mine)
                    best = _best(scores, ids[mine], numbers[mine], most)
                    out += [(int(number), int(numbers[mine[b]]), int(ids[mine[b]]), int(scores[b]), len(mine)) for b in best]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=_FOUND)
    return rows


_FOUND = ["query", "number", "vec_id", "score", "scored"]


def _negative_rows(most: int, least_share: int, most_share: int):
    """The best rows of a band per query and positive, kept over all row blocks of a task."""
    names = ["query", "positive_score", "number", "vec_id", "score", "scored"]

    def emitted(held: dict) -> pa.RecordBatch | None:
        out = [(*name, *row) for name, found in held.items() for row in found]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names) if out else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held, at = _Reader(), {}, None
        for batch in batches:
            for row in batch.to_pylist():
                if at != row["query_block"]:
                    if out := emitted(held):
                        yield out
                    held, at = {}, row["query_block"]
                codes = read(row)
                ids, numbers, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "numbers", "labels"))
                n = row["q_size"]
                asked = np.frombuffer(row["q_vectors"], np.int32).reshape(n, codes.dimensions).astype(np.int64)
                wanted = np.frombuffer(row["scores"], np.int64).reshape(n, -1)
                for query, number, label, positives in zip(
                        asked, np.frombuffer(row["q_numbers"], np.int64), np.frombuffer(row["q_labels"], np.int64), wanted):
                    others = np.flatnonzero(labels != label)
                    if not len(others):
                        continue
                    low, high = (b[others] for b in codes.interval(query))
                    for score in np.unique(positives[positives >= 0]).tolist():
                        bottom, top = least_share * score / 100, most_share * score / 100
                        found = held.setdefault((int(number), score), [])
                        sure = low[(low >= bottom) & (high <= top)]
                        least = max(bottom, np.partition(sure, -most)[-most]) if len(sure) >= most else bottom
                        if len(found) == most:
                            least = max(least, found[-1][2])
                        near = others[(high >= least) & (low <= top)]
                        if not len(near):
                            continue
                        scores = codes.scores(query, near)
                        inside = (least_share * score <= 100 * scores) & (100 * scores <= most_share * score)
                        near, exact = near[inside], scores[inside]
                        best = _best(exact, ids[near], numbers[near], most)
                        found += [(int(numbers[near[b]]), int(ids[near[b]]), int(exact[b]), len(scores)) for b in best]
                        found.sort(key=lambda f: (-f[2], f[1], f[0]))
                        del found[most:]
        if out := emitted(held):
            yield out
    return rows


def _parts(rows: Column, most: int) -> Column:
    return F.ceil(rows / most).cast("long")


def _dealt(parts: str) -> Column:
    return F.pmod(F.xxhash64("number"), F.col(parts))


def _numbers_to(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
    high: int = HIGH, block: int = ROWS, queries: int = QUERIES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors among ``rows``.

    ``rows`` (vec_id, embedding, label) are as ``usable`` gives them; ``is_anchor`` tells the anchors.  A score is
    the inner product of the vectors floor(256 * x); higher ones come first, then smaller ids.  An anchor's
    positives are its best other rows of the same label, its negatives for each of them the best rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score.  A repeated vec_id is a row
    each time.  Vectors of different lengths have no score with each other.  Anchors without positives, and positives without negatives
    in the band, give no rows; so does a negative positive score, whose band is empty.  A component of 2**24 or more
    after scaling is an error.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("vec_id", "embedding", "label").withColumns({
        "number": F.monotonically_increasing_id(), "anchor": F.coalesce(is_anchor, F.lit(False)),
        "dimensions": F.size("embedding")}), "vectors")
    # Large labels are cut into blocks; small ones share blocks.
    sizes = rows.groupBy("dimensions", "label").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).withColumn("small", F.col("n") < block // 4)
    small = sizes.where("small").groupBy("dimensions").agg(_parts(F.sum("n"), block).alias("shared"))
    homes = sizes.join(small, "dimensions", "left").withColumn(
        "home", F.when(F.col("small"), F.pmod(F.xxhash64("label"), F.col("shared"))).otherwise(F.col("label")))
    homes = stored(homes.select("dimensions", "label", "small", "home", "anchors",
                                F.when(F.col("small"), 1).otherwise(_parts(F.col("n"), block)).cast("long").alias("parts")), "homes")
    homed = rows.join(homes, ["dimensions", "label"]).withColumn("part", _dealt("parts"))
    place = ["dimensions", "small", "home", "part"]
    blocks = stored(
        homed.groupBy(*place).applyInArrow(
            _pack_coded(place), f"dimensions int, small boolean, home long, part long, {BLOCK}, {CODED}")
        .withColumn("block", F.monotonically_increasing_id()), "vector-blocks")

    asked = homed.where("anchor").withColumn("query_parts", _parts(F.greatest("anchors", F.lit(1)), queries))
    own = ["dimensions", "small", "home", "parts", "query_part"]
    first = (
        asked.withColumn("query_part", _dealt("query_parts")).groupBy(*own)
        .applyInArrow(_pack(own), f"dimensions int, small boolean, home long, parts long, query_part long, {BLOCK}")
        .withColumn("part", _numbers_to(F.col("parts"))))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "number")
    chosen = stored(
        blocks.join(_query_side(first, [*place]), place)
        .select("block", *_BLOCK_COLUMNS, "q_size", "q_numbers", "q_labels", "q_vectors")
        .mapInArrow(_positive_rows(positives), ", ".join(f"{c} long" for c in _FOUND))
        .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives)
        .select("query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "nth"), "positives")

    n_blocks = blocks.count()
    with_scores = chosen.where("positive_score >= 0").groupBy("query").agg(
        F.collect_set("positive_score").alias("scores"))
    again = rows.where("anchor").join(with_scores, F.col("number") == F.col("query"))
    n_queries = with_scores.count()
    if not n_queries:
        return spark.createDataFrame([], RESULT)
    n_parts = -(-n_queries // queries)
    groups, slots = min(n_parts, QUERY_GROUPS), -(-n_blocks // SLOT_BLOCKS)
    second = (
        again.withColumn("query_block", F.pmod(F.xxhash64("number"), F.lit(n_parts)))
        .groupBy("dimensions", "query_block")
        .applyInArrow(_pack_queries, f"dimensions int, query_block long, {BLOCK}, scores binary")
        .withColumn("group", F.col("query_block") % groups)
        .withColumn("slot", _numbers_to(F.lit(slots).cast("long"))))
    dealt = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots))).withColumn(
        "group", _numbers_to(F.lit(groups).cast("long")))
    found = (
        _query_side(second, ["dimensions", "slot", "group", "query_block", "scores"])
        .join(dealt, ["dimensions", "slot", "group"])
        .select("query_block", "block", *_BLOCK_COLUMNS, "q_size", "q_numbers", "q_labels", "q_vectors", "scores")
        .mapInArrow(_negative_rows(negatives, low, high),
                    "query long, positive_score long, number long, vec_id long, score long, scored long"))
    nth = Window.partitionBy("query", "positive_score").orderBy(F.desc("score"), "vec_id", "number")
    ranked = found.withColumn("rank", F.row_number().over(nth)).where(F.col("rank") <= negatives)
    return (
        chosen.join(rows.where("anchor").select(F.col("number").alias("query"), F.col("vec_id").alias("anchor_id")), "query")
        .join(ranked, ["query", "positive_score"])
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score")))


_BLOCK_COLUMNS = [part.split()[0] for part in f"{BLOCK}, {CODED}".split(", ")]
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _query_side(packed: DataFrame, keys: list[str]) -> DataFrame:
    return packed.select(*keys, *[F.col(c).alias(f"q_{c}") for c in ("size", "numbers", "labels", "vectors")])


def hard_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """``mine`` for anchors whose vec_id is divisible by ``every``; rows that ``usable`` leaves out take no part."""
    return mine(usable(embeddings), F.col("vec_id") % every == 0)
