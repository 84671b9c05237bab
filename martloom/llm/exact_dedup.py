"""Exact duplicates by two passes over hashes with a Bloom filter.

Pass one fills a filter with the hashes that may occur more than once.  Pass
two tests every row: rows outside the filter are certainly unique and pass
straight through; only the others shuffle, are grouped by the whole SHA-256
and find the row that stays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from martloom.llm import bloom
from martloom.session import stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White-space runs as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def _filter(codes: DataFrame, max_bytes: int) -> np.ndarray:
    _, twice = bloom.hash_filters(codes, "code", bloom.filter_bytes(codes.count(), max_bytes=max_bytes))
    return twice


def exact_groups(documents: DataFrame, max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``documents`` (doc_id, text, ...).

    ``keep_id`` is the smallest doc_id with the same normalised text.  A null
    text equals the empty one.  A repeated doc_id with the same text is kept
    each time; a null doc_id loses to any other and is kept where all are null.
    Other columns are not read.  ``max_bytes`` bounds the broadcast filter.
    """
    rows = stored(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256")), "hashes")
    code = F.xxhash64("text_sha256").alias("code")
    twice = _filter(rows.select(code), max_bytes)
    tested = rows.withColumn("again", bloom.maybe_in(twice, code))
    again = tested.where("again")
    # Written, so that the join reads both sides from plain shuffles and a group of many copies can be split.
    groups = stored(again.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    grouped = again.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    alone = tested.where("not again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(grouped)


def keep_first(documents: DataFrame, max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """One row of ``documents`` for every normalised text, with all its columns; rows of unique texts do not shuffle.

    The smallest doc_id stays, a null one only where all are null; of rows equal
    in id and text too, one stays.  Rows are decided on one by one, so ids may
    repeat.  A task sends one row per text on, however often the text occurs.
    """
    digest, again, nth = "__text_sha256", "__again", "__nth"
    codes = stored(documents.select(F.xxhash64(F.sha2(normalised(F.col("text")), 256)).alias("code")), "codes")
    rest = [F.xxhash64(c) for c, kind in documents.dtypes if "map<" not in kind and "variant" not in kind]
    tested = documents.withColumn(digest, F.sha2(normalised(F.col("text")), 256)).withColumn(
        again, bloom.maybe_in(_filter(codes, max_bytes), F.xxhash64(digest)))
    first = Window.partitionBy(digest).orderBy(F.col("doc_id").cast("long").asc_nulls_last(), *rest)
    alone = tested.where(~F.col(again))
    repeated = tested.where(again).withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
    return alone.unionByName(repeated).drop(digest, again)
