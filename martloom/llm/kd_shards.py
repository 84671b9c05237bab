"""Shards of near-equal bytes by a k-d tree over the metadata of text groups.

Equal texts form a group and stay together.  A node is split at the weighted
median of its widest dimension; medians are narrowed by histograms that Spark
sums over all groups, so the driver sees a few thousand bin sums per level,
whatever the corpus.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.session import stored

SHARDS = 16
BINS = 512
# A median is fine enough when the bin it lies in holds this share of the node's bytes.
FINE = 1e-4
ROUNDS = 6
# Rows numbered by one window; a shard is numbered in as many windows as it needs.
SLOT_ROWS = 2048
KEY = ["text_hash", "text_crc32", "size"]
DIMENSIONS = ["by_id", "by_size", "by_source", "by_lang"]


@dataclass
class Split:
    """Groups of ``node`` with ``dimension`` below ``cut`` go to ``left``, the others to ``right``."""

    node: int
    dimension: str
    cut: float
    left: int
    right: int


def _routed(splits: list[Split], node: int = 0) -> Column:
    """The tree as one nested condition; gives the leaf of a row."""
    split = next((s for s in splits if s.node == node), None)
    if split is None:
        return F.lit(node)
    return F.when(F.col(split.dimension) < split.cut, _routed(splits, split.left)).otherwise(_routed(splits, split.right))


def _by_node(column: str, values: dict[int, object]) -> Column:
    out = F.lit(None)
    for node, value in values.items():
        out = F.when(F.col("node") == node, value).otherwise(out)
    return out


def _cuts(groups: DataFrame, chosen: dict[int, str], low: dict, high: dict, goal: dict, total: dict) -> dict[int, float]:
    """Weighted quantiles of several nodes at once: where the bytes below come closest to the node's goal."""
    low, high, below = dict(low), dict(high), {n: 0 for n in chosen}
    cuts: dict[int, float] = {}
    open_nodes = set(chosen)
    for last in [*[False] * (ROUNDS - 1), True]:
        if not open_nodes:
            break
        value = _by_node("value", {n: F.col(chosen[n]) for n in open_nodes})
        a = _by_node("a", {n: F.lit(float(low[n])) for n in open_nodes})
        b = _by_node("b", {n: F.lit(float(high[n])) for n in open_nodes})
        bins = (
            groups.where(F.col("node").isin(*open_nodes)).withColumn("value", value)
            .where((F.col("value") >= a) & (F.col("value") <= b))
            .withColumn("bin", F.least(F.floor((F.col("value") - a) / F.nullif(b - a, F.lit(0.0)) * BINS), F.lit(BINS - 1)))
            .groupBy("node", "bin").agg(
                F.sum("weight").alias("weight"), F.min("value").alias("first"), F.max("value").alias("last"))
            .collect())
        for node in list(open_nodes):
            mine = sorted((r for r in bins if r["node"] == node), key=lambda r: r["first"])
            sums = below[node]
            for k, r in enumerate(mine):
                after = mine[k + 1]["first"] if k + 1 < len(mine) else None
                if sums + r["weight"] >= goal[node] or k + 1 == len(mine):
                    fine = last or r["weight"] <= FINE * total[node] or r["first"] == r["last"]
                    if fine:
                        # The bin goes to the side that brings the sum closer to the goal.
                        over, under = sums + r["weight"] - goal[node], goal[node] - sums
                        cuts[node] = after if after is not None and over <= under else r["first"]
                        open_nodes.discard(node)
                    else:
                        below[node], low[node], high[node] = sums, r["first"], r["last"]
                    break
                sums += r["weight"]
    return cuts


def build_tree(groups: DataFrame, shards: int) -> tuple[list[tuple], list[Split], dict[int, int]]:
    """(groups that fill a shard alone, splits, shard of each leaf).

    ``groups`` has a row per text group: the key columns, ``weight`` and the
    dimensions.  A group heavier than an even share gets a shard of its own;
    the rest is divided evenly over the other shards.
    """
    total = groups.agg(F.sum("weight")).first()[0] or 0
    alone: list[tuple] = []
    for row in groups.orderBy(F.desc("weight"), *KEY).limit(shards - 1).select(*KEY, "weight").collect():
        if row["weight"] * (shards - len(alone)) <= total:
            break
        alone.append(tuple(row[k] for k in KEY))
        total -= row["weight"]
    rest = groups.where(~_is_alone(alone))
    share = {0: shards - len(alone)}
    splits: list[Split] = []
    leaves: set[int] = set()
    widest: dict[str, float] = {}
    names = 1
    while any(k > 1 and n not in leaves for n, k in share.items()):
        now = rest.withColumn("node", _routed(splits))
        stats = {r["node"]: r for r in now.groupBy("node").agg(
            F.sum("weight").alias("weight"), *[f(d).alias(f"{n}_{d}") for d in DIMENSIONS
                                               for n, f in (("min", F.min), ("max", F.max))]).collect()}
        widest = widest or {d: stats[0][f"max_{d}"] - stats[0][f"min_{d}"] for d in DIMENSIONS if 0 in stats}
        chosen, low, high, goal, weight = {}, {}, {}, {}, {}
        for node, k in share.items():
            if k == 1 or node in leaves:
                continue
            r = stats.get(node)
            if r is None or all(r[f"max_{d}"] == r[f"min_{d}"] for d in DIMENSIONS):
                leaves.add(node)  # one group or none: nothing to divide
                continue
            d = max(DIMENSIONS, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / (widest[d] or 1))
            chosen[node], low[node], high[node] = d, r[f"min_{d}"], r[f"max_{d}"]
            goal[node], weight[node] = r["weight"] * (k // 2) / k, r["weight"]
        for node, cut in _cuts(now, chosen, low, high, goal, weight).items():
            if not low[node] < cut <= high[node]:
                cut = high[node]
            k = share.pop(node)
            splits.append(Split(node, chosen[node], cut, names, names + 1))
            share[names], share[names + 1] = k // 2, k - k // 2
            names += 2
    order = sorted(share)
    return alone, splits, {node: len(alone) + k for k, node in enumerate(order)}


def _is_alone(alone: list[tuple]) -> Column:
    out = F.lit(False)
    for key in alone:
        match = F.lit(True)
        for name, value in zip(KEY, key):
            match = match & (F.col(name) == F.lit(value))
        out = out | match
    return out


def _category(name: str) -> Column:
    """A place on the axis of a category; null has its own."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(name).cast("string"), F.lit("\u0000"))), F.lit(1 << 20)).cast("double")


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``documents`` (doc_id, text, lang, source).

    The law is ``bytes``: shard sizes are near equal, size being the text's
    UTF-8 bytes and one more.  Equal texts (a null one equals the empty one)
    share a shard; of fewer groups than shards some shards stay empty.  Slots
    count from 0 without gaps in every shard.  Null ids and repeated rows are
    rows like others; a null lang or source is a category of its own.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
        _category("source").alias("source_place"), _category("lang").alias("lang_place")), "shard-rows")
    tie = F.pmod(F.xxhash64(F.lit("tie"), *KEY), F.lit(1 << 32)) / F.lit(float(1 << 32))
    groups = stored(
        rows.groupBy(*KEY).agg(
            F.sum("size").alias("weight"), F.min("doc_id").alias("first_id"), F.min("source_place").alias("source_place"),
            F.min("lang_place").alias("lang_place"))
        .select(*KEY, "weight", (F.coalesce("first_id", F.lit(-1)) + tie).alias("by_id"), (F.col("size") + tie).alias("by_size"),
                (F.col("source_place") + tie).alias("by_source"), (F.col("lang_place") + tie).alias("by_lang")),
        "shard-groups")
    alone, splits, leaf_shard = build_tree(groups, shards)
    number = _routed(splits)
    place = F.lit(0)
    for leaf, k in leaf_shard.items():
        place = F.when(F.col("node") == leaf, k).otherwise(place)
    for k, key in enumerate(alone):
        place = F.when(_is_alone([key]), k).otherwise(place)
    placed = groups.withColumn("node", number).select(*KEY, place.cast("int").alias("shard"))

    found = rows.drop("source_place", "lang_place").join(placed, KEY)
    parts = F.lit(max(1, -(-rows.count() // (shards * SLOT_ROWS))))
    found = stored(found.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash"), parts)), "sharded")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", *KEY))
    return (
        found.withColumn("nth", nth).join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard")))
