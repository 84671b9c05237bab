"""Connected components of a link table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.session import merging, stored


# Links of a table that may go through the driver as one side of a join.
MOST_SENT = 250_000


def _pulled(pairs: DataFrame, keep_smaller: bool, large: bool) -> DataFrame:
    """One star step: every neighbour of ``u`` is linked to the smallest of ``u`` and its neighbours."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = pairs.join(merging(low) if large else low, "u")
    moved = met.where(F.col("v") > F.col("u")) if not keep_smaller else met
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep_smaller:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _is_forest_of_stars(pairs: DataFrame) -> bool:
    """Every node has one root, and no root has a root itself."""
    roles = pairs.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    odd = roles.groupBy("node").agg(F.sum("child").alias("roots"), F.max("root").alias("root")).where(
        "roots > 1 or (roots = 1 and root = 1)")
    return odd.agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link to another.

    ``links`` may hold both directions, repeats and self links.  Nulls are
    dropped.  Alternates large-star and small-star steps (a logarithmic number
    in practice); each round is written to the shared folder, so no lineage
    grows and a lost executor costs one round.  Nothing is collected but a
    counts.  Many links are joined without a broadcast.  A hub with many links is one hot join key against a
    single row, which adaptive execution splits.
    """
    pairs = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    pairs = stored(pairs, name)
    while not _is_forest_of_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = pairs.count() > MOST_SENT
        pairs = stored(_pulled(_pulled(both, False, large), True, large), name)
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)
