"""Data Vault tables from a short description of each.

Rows are selected, joined to their parents and de-duplicated on the business
keys; the hash keys are computed last, once per stored row.  Business keys are
narrower than hashes, so less is shuffled.  Each function returns the full
table; ``writes.new_rows`` gives what a run has to append.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.keys import known_uuid3
from martloom.operators.writes import first_per_key


def lineage(load_dt, load_src: str) -> dict[str, Column]:
    """The two technical columns every vault table ends with."""
    stamp = load_dt if isinstance(load_dt, Column) else F.lit(load_dt).cast("timestamp_ntz")
    return {"load_dt": stamp, "load_src": F.lit(load_src)}


def hub(stage: DataFrame, key: str, business: str, carried: list[str], load: dict[str, Column]) -> DataFrame:
    """One row per business key; ``carried`` columns come from its first row by their order."""
    known = stage.where(F.col(business).isNotNull()).select(business, *carried)
    one = first_per_key(known, [business], [F.col(c) for c in carried]) if carried else known.distinct()
    return one.select(known_uuid3(business).alias(key), business, *carried).withColumns(load)


def having_parents(rows: DataFrame, owners: dict[str, DataFrame]) -> DataFrame:
    """Rows whose parents exist; ``owners`` maps a business key to the hub that holds it."""
    for business, owner in owners.items():
        rows = rows.join(owner.select(business), business, "left_semi")
    return rows


def link(
    stage: DataFrame, key: str, parents: dict[str, str], load: dict[str, Column],
    owners: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Distinct combinations of parents; ``parents`` maps each hash column to its business key."""
    pairs = stage.select(*parents.values()).dropna().distinct()
    hashed = having_parents(pairs, owners or {}).select(
        *[known_uuid3(business).alias(name) for name, business in parents.items()])
    return hashed.select(known_uuid3(*parents).alias(key), *parents).withColumns(load)


def satellite(
    stage: DataFrame, parents: dict[str, str], payload: list[str], load: dict[str, Column],
    owners: dict[str, DataFrame] | None = None, link_key: str | None = None, own_key: str | None = None,
) -> DataFrame:
    """Payload rows of a hub, or of a link if ``link_key`` is given.

    With ``own_key`` the rows are distinct and get a key made of the parent
    and every payload column, so that any change is kept.
    """
    rows = having_parents(stage.dropna(subset=list(parents.values())), owners or {})
    rows = rows.select(*parents.values(), *payload)
    if own_key:
        rows = rows.distinct()
    hashed = rows.select(*[known_uuid3(business).alias(name) for name, business in parents.items()], *payload)
    if link_key:
        return hashed.select(known_uuid3(*parents).alias(link_key), *payload).withColumns(load)
    if own_key:
        # Hashes have a fixed length; only payload columns need a mark between them.
        marked = [part for column in payload for part in (F.lit("|"), column)][1:]
        return hashed.select(known_uuid3(*parents, *marked).alias(own_key), *parents, *payload).withColumns(load)
    return hashed.withColumns(load)
