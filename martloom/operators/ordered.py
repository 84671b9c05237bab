"""Ordered per-key operations that stay distributed when one key is huge.

A plain window over a key puts all rows of that key into one task.  Here each
key is cut into time slices: the window runs inside (key, slice), and what has
to cross a slice border is carried by one row per (key, slice).  The result
equals the plain window; a key holding a third of all rows is spread over as
many tasks as it has slices.  ``slice_by`` must not decrease along ``order``,
and the key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

_SLICE, _INSIDE, _EDGE, _CARRY = "__slice", "__inside", "__edge", "__carry"


def hourly(ts) -> Column:
    return F.date_trunc("hour", ts)


def daily(ts) -> Column:
    return F.to_date(ts)


def _sliced(
    df: DataFrame,
    keys: list[str],
    order: list,
    slice_by: Column,
    inside: Callable,
    at_edge: Column,
    carried: Callable,
    backwards: bool = False,
    of_keys: Callable | None = None,
) -> DataFrame:
    """Add ``__inside`` (value within the slice) and ``__carry`` (from the slices before).

    ``at_edge`` is what a slice hands over, taken from its last row (its first
    row if ``backwards``); ``carried`` combines the handed-over values per key.
    """
    within = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    beyond = F.lag if backwards else F.lead
    rows = (
        df.withColumn(_SLICE, slice_by)
        .withColumn(_INSIDE, inside(within))
        .withColumn(_EDGE, beyond(F.lit(1)).over(within).isNull())
    )
    across = Window.partitionBy(*keys).orderBy(F.desc(_SLICE) if backwards else F.asc(_SLICE))
    edges = (
        rows.where(F.col(_EDGE))
        .select(*keys, _SLICE, at_edge.alias(_CARRY))
        .transform(of_keys or (lambda kept: kept))
        .withColumn(_CARRY, carried(F.col(_CARRY), across))
    )
    return rows.join(edges, [*keys, _SLICE], "inner" if of_keys else "left").drop(_SLICE, _EDGE)


def with_neighbour(
    df: DataFrame, keys: list[str], order: list, columns: dict[str, str], slice_by: Column,
    following: bool = False, of_keys: Callable | None = None, few: bool = False,
) -> DataFrame:
    """Values of the row before (or after) each row of the same key.

    ``columns`` maps a source column to the name of the new one.  The new
    columns are NULL for the first (last) row of a key.  ``few`` is for narrow
    rows with few of them in a slice: ``df`` is computed once, but all its rows
    pass both windows.
    """
    shift = F.lead if following else F.lag
    if of_keys:
        packed = F.struct(*columns)
        out = _sliced(
            df, keys, order, slice_by,
            inside=lambda w: shift(packed).over(w),
            at_edge=packed,
            carried=lambda value, w: F.lag(value).over(w),
            backwards=following,
            of_keys=of_keys,
        )
        near = F.coalesce(F.col(_INSIDE), F.col(_CARRY))
        return out.withColumns({new: near[old] for old, new in columns.items()}).drop(_INSIDE, _CARRY)
    # Only the first row of a slice (the last if ``following``) needs a value from another slice: it takes along what
    # its own slice hands over and meets those of the other slices.  Nothing is joined back to the rows.
    within = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    handed = F.first if following else F.last
    rows = df.withColumn(_SLICE, slice_by).withColumns({
        _EDGE: shift(F.lit(1)).over(within).isNull(),
        **{f"{_INSIDE}_{new}": shift(old).over(within) for old, new in columns.items()},
        **{f"{_CARRY}_{new}": handed(old).over(whole) for old, new in columns.items()}})
    across = Window.partitionBy(*keys).orderBy(F.desc(_SLICE) if following else F.asc(_SLICE))
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in [*keys, _SLICE]])
    if few:
        # The rows that need nothing from another slice stay with their own, so a huge key is spread here too.
        apart = across.partitionBy(*keys, _EDGE, F.when(~F.col(_EDGE), F.col(_SLICE)))
        met = rows.withColumns({f"{_CARRY}_{new}": F.lag(f"{_CARRY}_{new}").over(apart) for new in columns.values()})
        return met.select(*df.columns, *[
            F.when(~F.col(_EDGE), F.col(f"{_INSIDE}_{new}")).when(known, F.col(f"{_CARRY}_{new}")).alias(new)
            for new in columns.values()])
    inner = rows.where(~F.col(_EDGE)).select(*df.columns, *[F.col(f"{_INSIDE}_{new}").alias(new) for new in columns.values()])
    edges = rows.where(F.col(_EDGE)).select(*df.columns, *[
        F.when(known, F.lag(f"{_CARRY}_{new}").over(across)).alias(new) for new in columns.values()])
    return inner.unionByName(edges)


def with_last_known(
    df: DataFrame, keys: list[str], order: list, column: str, slice_by: Column, name: str
) -> DataFrame:
    """Latest non-NULL ``column`` up to and including each row."""
    out = _sliced(
        df, keys, order, slice_by,
        inside=lambda w: F.last(column, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        at_edge=F.col(_INSIDE),
        carried=lambda value, w: F.last(value, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)),
    )
    return out.withColumn(name, F.coalesce(_INSIDE, _CARRY)).drop(_INSIDE, _CARRY)


def with_position(
    df: DataFrame, keys: list[str], order: list, slice_by: Column, name: str
) -> DataFrame:
    """1-based position of each row within its key."""
    out = _sliced(
        df, keys, order, slice_by,
        inside=lambda w: F.row_number().over(w),
        at_edge=F.col(_INSIDE).cast("long"),
        carried=lambda value, w: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)),
    )
    position = F.col(_INSIDE) + F.coalesce(F.col(_CARRY), F.lit(0))
    return out.withColumn(name, position.cast("long")).drop(_INSIDE, _CARRY)


def changes(
    df: DataFrame, keys: list[str], order: list, column: str, slice_by: Column, of_keys: Callable | None = None,
) -> DataFrame:
    """Rows whose ``column`` differs from the row before, and the first row of each key; ``of_keys`` as in ``_sliced``."""
    out = with_neighbour(df, keys, order, {column: "__before"}, slice_by, of_keys=of_keys)
    return out.where((F.col(column) != F.col("__before")) | F.col("__before").isNull()).drop("__before")
