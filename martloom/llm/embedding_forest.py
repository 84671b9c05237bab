"""Near-duplicate vectors by a forest of random-projection trees with spill.

For every label several trees are fitted on a bounded sample: a node splits at
the median of its vectors' projections on a random direction.  All vectors are
sent down all trees; one that projects close to a split goes to both sides.
Vectors are compared within leaves, in double precision; a pair that meets in
several leaves counts in the first.  Links are merged into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martloom.llm.components import components
from martloom.session import stored

SIMILARITY = 0.98
TREES = 6
LEAF = 128
# Vectors of the sample that fits the trees, over all labels; it bounds what the driver holds.
SAMPLE = 65_536
# Vectors whose projection is nearer to a split than this go to both sides.  Unit vectors of cosine
# 0.98 are 0.2 apart, so their projections in 64 dimensions differ by 0.025 in the typical case.
SPILL = 0.015
DEPTH = 24
# Vectors of a leaf that one task compares; a larger leaf is compared by pairs of blocks.
BLOCK = 2048


@dataclass
class Node:
    direction: np.ndarray | None = None
    cut: float = 0.0
    left: "Node | None" = None
    right: "Node | None" = None
    leaf: int = -1


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def grow(vectors: np.ndarray, random: np.random.Generator, leaf: int = LEAF, spill: float = SPILL) -> Node:
    """A tree over unit vectors.  A node that a split does not divide stays a leaf."""
    root, count = Node(), 0
    todo = [(root, np.arange(len(vectors)), 0)]
    while todo:
        node, mine, depth = todo.pop()
        if len(mine) > leaf and depth < DEPTH:
            direction = random.normal(size=vectors.shape[1])
            direction /= np.linalg.norm(direction)
            place = vectors[mine] @ direction
            cut = float(np.median(place))
            left, right = mine[place <= cut + spill], mine[place > cut - spill]
            if max(len(left), len(right)) <= 0.85 * len(mine):
                node.direction, node.cut, node.left, node.right = direction, cut, Node(), Node()
                todo += [(node.right, right, depth + 1), (node.left, left, depth + 1)]
                continue
        node.leaf = count
        count += 1
    return root


def leaves_of(root: Node, vectors: np.ndarray, spill: float = SPILL) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that each vector reaches."""
    rows, leaves = [], []
    todo = [(root, np.arange(len(vectors)))]
    while todo:
        node, mine = todo.pop()
        if not len(mine):
            continue
        if node.direction is None:
            rows.append(mine)
            leaves.append(np.full(len(mine), node.leaf))
        else:
            place = vectors[mine] @ node.direction
            todo += [(node.right, mine[place > node.cut - spill]), (node.left, mine[place <= node.cut + spill])]
    return np.concatenate(rows), np.concatenate(leaves)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length from a column of lists."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def fit(classes: DataFrame, trees: int, sample: int) -> dict[tuple, list[Node]]:
    """Trees by (label, dimensions), from the vectors with the smallest hashes: ``sample`` in expectation.

    A label too small in the sample for a split needs no tree: it is one leaf.
    """
    total = classes.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), "rep"), F.lit(1 << 30)) / (1 << 30)
    chosen = classes.where(place < sample / max(total, 1)).select("label", "size", "embedding").toArrow()
    found: dict[tuple, list[Node]] = {}
    frame = chosen.select(["label", "size"]).to_pandas()
    for key, rows in frame.groupby(["label", "size"]).indices.items():
        if len(rows) > LEAF:
            vectors = unit(_matrix(chosen.column("embedding").take(pa.array(np.sort(rows))).combine_chunks()))
            seed = int(pd.util.hash_array(np.array([str(key)], object))[0] & 0x7FFFFFFF)
            found[key] = [grow(vectors, np.random.default_rng([seed, t])) for t in range(trees)]
    return found


def _routed(forest: dict[tuple, list[Node]]):
    """Rows (cell, codes, ...) for each leaf of each vector; ``codes`` are all cells of the vector, in order."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            frame = pd.DataFrame({"label": batch.column(0).to_pandas(), "size": batch.column(1).to_pandas()})
            for key, mine in frame.groupby(["label", "size"]).indices.items():
                mine = np.sort(mine)
                part = batch.take(pa.array(mine))
                roots = forest.get(key) or [Node(leaf=0)]
                vectors = unit(_matrix(part.column(3)))
                places = [leaves_of(root, vectors) for root in roots]
                row = np.concatenate([r for r, _ in places])
                code = np.concatenate([(t << 32) | leaf for t, (_, leaf) in enumerate(places)])
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                first = np.searchsorted(row, np.arange(len(mine) + 1))
                codes = [code[a:b].astype("<i8").tobytes() for a, b in zip(first[:-1], first[1:])]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(code, pa.int64()),
                     part.column(2).take(at), part.column(4).take(at), pa.array(codes, pa.binary()).take(at),
                     part.column(3).take(at)],
                    names=["label", "size", "code", "rep", "copies", "codes", "embedding"])
    return rows


def _met_before(codes: list[bytes], code: int) -> np.ndarray:
    """(n, k) membership in earlier cells that several of the rows share."""
    lists = [np.frombuffer(c, "<i8") for c in codes]
    lists = [c[c < code] for c in lists]
    row = np.repeat(np.arange(len(lists)), [len(c) for c in lists])
    values, at, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    keep = times[at] > 1
    member = np.zeros((len(codes), int((times > 1).sum())), np.float32)
    member[row[keep], column[at[keep]]] = 1
    return member


def _smallest_linked(linked: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row over the links."""
    root = np.arange(len(linked))
    while True:
        lower = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def _linked_rows(vectors: np.ndarray, block: np.ndarray, across: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a link, links among them).

    Rows of one cell are compared with each other; if ``across``, only rows of
    different blocks.
    """
    linked = vectors @ vectors.T >= least
    np.fill_diagonal(linked, False)
    if across:
        linked &= block[:, None] != block[None, :]
    rows = np.flatnonzero(linked.any(axis=1))
    return rows, linked[np.ix_(rows, rows)]


def _compared(least: float):
    """(rep, links, other): the links that count in this cell, and a row that the vector is connected to.

    A link that an earlier cell holds as well counts there, but connects here too.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        cell, rep, copies, block, code = (
            table.column(n).to_numpy() for n in ("cell", "rep", "copies", "block", "code"))
        across, codes = table.column("across").to_numpy(zero_copy_only=False), table.column("codes")
        embedding = table.column("embedding").chunk(0)
        values, start = embedding.flatten().to_numpy(zero_copy_only=False), embedding.offsets.to_numpy()
        start = start - start[0]
        order = np.lexsort((rep, cell))
        ends = np.flatnonzero(cell[order][1:] != cell[order][:-1]) + 1
        for mine in np.split(order, ends):
            if len(mine) < 2:
                continue
            size = start[mine[0] + 1] - start[mine[0]]
            vectors = unit(values[start[mine][:, None] + np.arange(size)])
            found, linked = _linked_rows(vectors, block[mine], bool(across[mine[0]]), least)
            if not len(found):
                continue
            mine = mine[found]
            member = _met_before(codes.take(pa.array(mine)).to_pylist(), int(code[mine[0]]))
            counts = np.zeros(len(mine), np.int64)
            for first in range(0, len(mine), 512):
                fresh = linked[first:first + 512]
                if member.shape[1]:
                    fresh = fresh & ~(member[first:first + 512] @ member.T > 0)
                counts[first:first + 512] = fresh @ copies[mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[mine]), pa.array(counts), pa.array(rep[mine][_smallest_linked(linked)])], schema=schema)
    return rows


def near_vectors(
    embeddings: DataFrame, least: float = SIMILARITY, trees: int = TREES, sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, label, ...).

    Only vectors with equal labels and equally many dimensions are compared.
    A vector that is null, empty, zero, or holds a null or non-finite value,
    one without label and one without vec_id link with nothing.  Equal vectors
    of a label are one class: each copy is a link.  Pairs found have a cosine of
    ``least`` or more; a few that no leaf brings together can be missed.
    Repeated vec_ids are rows of their own.  Other columns are not read.
    """
    kind = embeddings.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding").cast(kind if kind in ("array<float>", "array<double>") else "array<double>")
    good = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0))
    rows = stored(embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("embedding"),
        F.coalesce(good, F.lit(False)).alias("good"), F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit("second"), "embedding").alias("h2")), "vectors")
    key = ["label", "h1", "h2"]
    classes = stored(
        rows.where("good").groupBy(*key).agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("size", F.size("embedding")), "vector-classes")
    forest = fit(classes, trees, sample)
    label, vector = (classes.schema[name].dataType.simpleString() for name in ("label", "embedding"))
    routed = stored(
        classes.select("label", "size", "rep", "embedding", "copies").mapInArrow(
            _routed(forest), f"label {label}, size int, code long, rep long, copies long, codes binary, embedding {vector}"),
        "routed")
    place = ["label", "size", "code"]
    large = stored(routed.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select(
        *place, ((F.col("n") + (BLOCK - 1)) / BLOCK).cast("long").alias("parts")), "large-leaves")
    # The join only finds the leaves to be cut into blocks; without any it would move all vectors for nothing.
    cut = routed.withColumn("parts", F.lit(1).cast("long")) if large.isEmpty() else (
        routed.join(large, place, "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))))
    # Each block meets every block: a row goes once to each pair of blocks that its own is in.
    split = (
        cut.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("code", "rep", "copies", "codes", "embedding", "block", (F.col("block") != F.col("other")).alias("across"),
                F.xxhash64(*place, F.least("block", "other"), F.greatest("block", "other")).alias("cell")))
    found = stored(
        split.repartition("cell").mapInArrow(_compared(least), "rep long, links long, other long"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found, "rep", "other", "vector-components")
    known = (
        classes.join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
        .select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                F.coalesce("root", "rep").alias("component_id")))
    linked = rows.where("good").join(known, key).select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
