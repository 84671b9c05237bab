"""Relational sources and sinks.

A relation is named by a Spark format and its options, for example
``("jdbc", jdbc_options(...))``.  Filters are written on the DataFrame: Spark
pushes them into the database, or into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.operators import state as load_state
from martloom.operators.writes import new_rows


def jdbc_options(
    url: str, table: str, driver: str | None = None, user: str | None = None, password: str | None = None,
    partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 1, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column it is read by parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options.update({k: v for k, v in {"driver": driver, "user": user, "password": password}.items() if v})
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds: the smallest and largest value to divide")
        low, high = bounds
        options.update(
            partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high),
            numPartitions=str(partitions))
    return options


def read_relation(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    return spark.read.format(fmt).options(**options).load()


def snapshot_copy(spark: SparkSession, fmt: str, options: dict[str, str], columns: list[str], target: str) -> DataFrame:
    """Copy a relation, replacing the target; returns the copy."""
    read_relation(spark, fmt, options).select(*columns).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def outbox_increment(
    source: DataFrame, loaded: DataFrame, state: DataFrame, run_id: int,
    layer: str = "stg", origin: str = "outbox", table: str = "events",
) -> tuple[DataFrame, DataFrame]:
    """Rows with an id above the stored one that are not loaded yet, and the new state.

    Rows above the stored id are loaded already only if a run died before it
    moved the state, so no more of the target is read.
    """
    last = load_state.read(state, layer, origin, table)
    above = F.lit(True) if last is None else F.col("id") > int(last)
    batch = source.where(above)
    fresh = new_rows(loaded.where(above), batch, ["id"], [F.col("event_ts"), F.col("event_value")])
    moved = load_state.progress(batch, layer, origin, table, F.col("id"), run_id)
    return fresh.select(loaded.columns), load_state.advance(state, moved)


def backfill_start(source: DataFrame, column: str) -> Column:
    """First day present in the source, as a scalar for the first run."""
    return source.agg(F.to_date(F.min(column)).alias("day")).scalar()


def day_slices(
    source: DataFrame, column: str, until, since=None, load_src: str = "relational", load_dt: Column | None = None,
) -> DataFrame:
    """All days from ``since`` (default: the first day present) up to, not including, ``until``.

    One range predicate replaces a query per day; ``load_day`` partitions the
    target, so repeating a run replaces its own days only.
    """
    start = F.lit(since).cast("date") if since is not None else backfill_start(source, column)
    out = (
        source.where(F.col(column) >= start.cast("timestamp_ntz"))
        .where(F.col(column) < F.lit(until).cast("date").cast("timestamp_ntz"))
        .withColumns({"load_src": F.lit(load_src), "load_day": F.to_date(column)})
    )
    return out if load_dt is None else out.withColumn("load_dt", load_dt)


def append_relation(df: DataFrame, fmt: str, options: dict[str, str]) -> None:
    df.write.format(fmt).mode("append").options(**options).save()
