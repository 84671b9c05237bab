"""Write semantics as pure functions: (target, source) -> new target.

Publishing the result is a separate step (``sources.tables``).  Every
de-duplication names the order that decides the surviving row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.operators.ordered import daily, with_neighbour

OPEN_END = "2099-12-31 00:00:00"


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first by ``order``.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    the copies of a hot key are dropped where they are read.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of ``source`` whose key is neither NULL nor already in ``target``."""
    known_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    fresh = first_per_key(source.where(known_key), keys, order)
    return fresh.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Existing rows win; among new rows the first by ``order`` wins."""
    return target.unionByName(new_rows(target, source, keys, order).select(target.columns))


def upsert_last_wins(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key by ``order`` wins; on a tie the source wins."""
    both = target.withColumn("__source", F.lit(0)).unionByName(
        source.select(target.columns).withColumn("__source", F.lit(1)))
    latest = [F.desc(c) for c in order] + [F.desc("__source")]
    return first_per_key(both, keys, latest).drop("__source")


def additive_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """Measures of equal keys are added; other columns keep their smallest value."""
    rest = [c for c in target.columns if c not in keys and c not in measures]
    out = (
        target.unionByName(source.select(target.columns))
        .groupBy(*keys)
        .agg(*[F.sum(m).alias(m) for m in measures], *[F.min(c).alias(c) for c in rest])
    )
    return out.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str], order: list) -> DataFrame:
    """MERGE with only a ``WHEN NOT MATCHED THEN INSERT`` branch."""
    return insert_if_absent(target, source, keys, order)


def versioned(
    changes_: DataFrame, keys: list[str], payload: list[str], valid_from: str
) -> DataFrame:
    """History rows with ``active_from`` / ``active_to``; the last version stays open.

    Rows that repeat the payload of the version before start no new version.
    If a key changes twice at one moment, the greatest payload is taken.
    """
    stamped = (
        changes_.groupBy(*keys, F.col(valid_from).alias("active_from"))
        .agg(F.max(F.struct(*payload)).alias("__payload"))
    )
    order, slices = [F.col("active_from")], daily(F.col("active_from"))
    distinct_versions = with_neighbour(
        stamped, keys, order, {"__payload": "__before"}, slices, few=True
    ).where(~F.col("__payload").eqNullSafe(F.col("__before")))
    closed = with_neighbour(
        distinct_versions.drop("__before"), keys, order, {"active_from": "__next"}, slices,
        following=True, few=True)
    open_end = F.lit(OPEN_END).cast("timestamp_ntz")
    return closed.select(
        *keys, "__payload.*", "active_from", F.coalesce("__next", open_end).alias("active_to"))
