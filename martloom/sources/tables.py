"""Published tables: whole versions and appended batches, as Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.operators.writes import first_per_key
from martloom.session import COMPRESSION, shuffles_removed

VERSION = "version="


def _versions(spark: SparkSession, location: str) -> list[int]:
    """Complete versions of a table; one is complete once its success marker exists."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(location)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    return sorted(
        int(entry.getPath().getName()[len(VERSION):])
        for entry in files.listStatus(root)
        if entry.getPath().getName().startswith(VERSION)
        and files.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
    )


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, the same columns: a table before its first load."""
    return df.sparkSession.createDataFrame([], df.schema)


def overwrite(df: DataFrame, location: str, partition_by: list[str] | None = None) -> None:
    """Replace a mart: one folder per mart, full overwrite."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(location)


def publish(df: DataFrame, location: str, sort_by: list[str] | None = None) -> int:
    """Write the next version of a table; readers keep the old one until it is complete.

    ``sort_by`` orders each file, so that readers skip row groups by min/max.  A job that dies half-way leaves a folder without a success marker, which
    readers skip and the next run overwrites.  One writer per table.
    """
    spark = df.sparkSession
    version = max(_versions(spark, location), default=0) + 1
    ordered = df.sortWithinPartitions(*sort_by) if sort_by else df
    with shuffles_removed(spark):
        ordered.write.mode("overwrite").parquet(f"{location}/{VERSION}{version}", compression=COMPRESSION)
    return version


def latest(spark: SparkSession, location: str) -> DataFrame | None:
    """The newest complete version, or None before the first."""
    versions = _versions(spark, location)
    return spark.read.parquet(f"{location}/{VERSION}{versions[-1]}") if versions else None


def append_batch(df: DataFrame, location: str, batch_id: int) -> None:
    """Append one batch as its own folder; repeating the batch replaces it."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").parquet(f"{location}/batch_id={batch_id}", compression=COMPRESSION)


def write_texts(df: DataFrame, location: str, mode: str = "error") -> None:
    """One text per line, compressed."""
    with shuffles_removed(df.sparkSession):
        df.write.mode(mode).text(location, compression="gzip")


def merged(spark: SparkSession, location: str, keys: list[str], newest: bool = False) -> DataFrame:
    """One row per key of an appended table: the first batch that brought it, or the newest.

    A stream appends without looking at the history; this view decides which
    row counts.  Publishing the view from time to time compacts the batches.
    """
    order = F.desc("batch_id") if newest else F.asc("batch_id")
    return first_per_key(spark.read.parquet(location), keys, [order]).drop("batch_id")


def save_bucketed(df: DataFrame, name: str, location: str, key: str, buckets: int) -> DataFrame:
    """Catalog table bucketed and sorted by ``key``: joins on it need no shuffle of either side."""
    (df.repartition(buckets, key).write.mode("overwrite").option("path", location)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def replace_slices(df: DataFrame, location: str, slice_column: str) -> None:
    """Write a slice-partitioned table, replacing only the slices present in ``df``.

    The rebalance gathers small slices into few files and splits large ones.
    """
    (df.hint("rebalance", slice_column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(slice_column).parquet(location))
