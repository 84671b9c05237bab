"""Joins that need more than a plain equi-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def salted_join(many: DataFrame, few: DataFrame, on: list[str], spread_by: list[str], salts: int) -> DataFrame:
    """Inner equi-join that splits each key of ``many`` over ``salts`` tasks.

    For plans without adaptive skew handling (inside a stream).  ``few`` is
    repeated ``salts`` times, so it should be the smaller side.
    """
    left = many.withColumn("__salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    right = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "__salt"]).drop("__salt")


def orphans(child: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Distinct key values of ``child`` that no parent row has: (key_name, key_value).

    ``parents`` maps a key column of the child to the dimension that owns it
    under the same name.  One anti-join per dimension, on distinct values.
    """
    parts = []
    for key, parent in parents.items():
        used = child.where(F.col(key).isNotNull()).select(key).distinct()
        parts.append(
            used.join(parent.select(key), key, "left_anti")
            .select(F.lit(key).alias("key_name"), F.col(key).cast("string").alias("key_value")))
    return reduce(DataFrame.unionByName, parts)


def with_placeholders(dim: DataFrame, facts: DataFrame, key: str, fills: dict) -> DataFrame:
    """Late-arriving dimension: add a placeholder row for each unknown key of the facts.

    The keys are reduced to distinct values before the anti-join.  A real row
    that comes later replaces its placeholder with ``upsert_last_wins``.
    """
    missing = (
        facts.where(F.col(key).isNotNull()).select(key).distinct()
        .join(dim.select(key), key, "left_anti")
        .withColumns(fills)
    )
    return dim.unionByName(missing.select(dim.columns))
