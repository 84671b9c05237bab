"""Load state: how far each (layer, source, table) has been loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.operators.writes import upsert_last_wins

KEYS = ["layer", "source", "table"]
SCHEMA = "layer string, source string, table string, value string, run_id long"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def read(state: DataFrame, layer: str, source: str, table: str) -> str | None:
    """The stored value, one row by key; None before the first run, which loads everything."""
    row = state.where(
        (F.col("layer") == layer) & (F.col("source") == source) & (F.col("table") == table)
    ).select("value").first()
    return row[0] if row else None


def progress(loaded: DataFrame, layer: str, source: str, table: str, position: Column, run_id: int) -> DataFrame:
    """State row for a batch: its greatest position.  An empty batch gives no row."""
    return (
        loaded.agg(F.max(position).cast("string").alias("value"))
        .where("value is not null")
        .select(
            F.lit(layer).alias("layer"), F.lit(source).alias("source"), F.lit(table).alias("table"),
            "value", F.lit(run_id).cast("long").alias("run_id"))
    )


def advance(state: DataFrame, *rows: DataFrame) -> DataFrame:
    """Replace the stored rows by newer ones."""
    out = state
    for row in rows:
        out = upsert_last_wins(out, row, KEYS, ["run_id"])
    return out
