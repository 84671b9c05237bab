"""Delimited files: typed bulk load with rejects, file discovery, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CORRUPT = "_rejected_line"


def load_csv(
    spark: SparkSession, location, schema: str, header: bool = False, delimiter: str = ",",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Lines read by position into ``schema``; a bad line keeps its text in ``CORRUPT``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string").options(**(options or {}))
        .options(header=header, sep=delimiter, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                 recursiveFileLookup=True)
        .csv(location)
    )


def good_rows(loaded: DataFrame) -> DataFrame:
    return loaded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_rows(loaded: DataFrame) -> DataFrame:
    """Text and file of the bad lines."""
    # Spark refuses to read the corrupt column alone, as nothing would be
    # parsed then; this condition is always true and needs the other columns.
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in loaded.columns if c != CORRUPT])) >= 0
    return loaded.where(F.col(CORRUPT).isNotNull() & parsed).select(
        F.col(CORRUPT).alias("rejected_line"), F.col("_metadata.file_path").alias("source_file"))


def list_files(spark: SparkSession, location: str, key_part: str) -> DataFrame:
    """(file_path, modified) of the files whose path holds ``key_part``; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
        .select(F.col("_metadata.file_path").alias("file_path"),
                F.col("_metadata.file_modification_time").alias("modified"))
        .where(F.col("file_path").contains(key_part))
    )


def files_to_load(found: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files the manifest does not know, however old, and those newer than it says."""
    if manifest is None:
        return found
    known = manifest.select("file_path", F.col("modified").alias("loaded"))
    return found.join(known, "file_path", "left").where(
        F.col("loaded").isNull() | (F.col("modified") > F.col("loaded"))).drop("loaded")


def updated_manifest(found: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """One row per file with its latest time, to be stored after the load."""
    both = found if manifest is None else found.unionByName(manifest.select("file_path", "modified"))
    return both.groupBy("file_path").agg(F.max("modified").alias("modified"))


def load_files(
    spark: SparkSession, location: str, schema: str, selected: DataFrame, load_dt: Column,
    load_src: str = "S3", columns: list[str] | None = None, header: bool = True,
) -> DataFrame:
    """Good rows of the selected files with lineage columns, their file and its time.

    Only the selected files are read: Spark lists them on the driver anyway, so
    their paths are all that passes through it.  All files share one layout.
    ``newest_files`` shows each file's rows once, however often it was touched.
    """
    paths = [row["file_path"] for row in selected.select("file_path").collect()]
    if not paths:
        empty = with_lineage(spark.createDataFrame([], schema), load_dt, load_src, columns)
        return empty.withColumns({"file_path": F.lit(""), "modified": F.lit(None).cast("timestamp")})
    loaded = load_csv(spark, paths, schema, header=header)
    kept = columns or [c for c in loaded.columns if c != CORRUPT]
    from_file = loaded.withColumns({
        "file_path": F.col("_metadata.file_path"), "modified": F.col("_metadata.file_modification_time")})
    return with_lineage(good_rows(from_file), load_dt, load_src, [*kept, "file_path", "modified"])


def rejected_lines(spark: SparkSession, schema: str, selected: DataFrame, header: bool = True) -> DataFrame:
    """Bad lines of the selected files: (rejected_line, source_file)."""
    paths = [row["file_path"] for row in selected.select("file_path").collect()]
    if not paths:
        return spark.createDataFrame([], "rejected_line string, source_file string")
    return rejected_rows(load_csv(spark, paths, schema, header=header))


def newest_files(loaded: DataFrame) -> DataFrame:
    """Rows of the latest reading of every file: a file touched and loaded again replaces its old rows.

    The latest times are one row per file and join the rows; they are not ranked.
    """
    latest = loaded.groupBy("file_path").agg(F.max(F.struct("modified", "batch_id")).alias("latest"))
    newest = latest.select("file_path", "latest.modified", "latest.batch_id")
    return loaded.join(newest, ["file_path", "modified", "batch_id"], "left_semi").drop("file_path", "modified", "batch_id")


def with_lineage(rows: DataFrame, load_dt: Column, load_src: str, columns: list[str] | None = None) -> DataFrame:
    """Add ``load_dt`` and ``load_src``; optionally keep only named columns besides them."""
    kept = rows.select(*columns) if columns else rows
    return kept.withColumns({"load_dt": load_dt, "load_src": F.lit(load_src)})
