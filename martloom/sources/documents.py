"""Landed JSON: document collections, API payloads, mixed envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.functions.text import json_rejects, with_checked, with_parsed
from martloom.operators import state as load_state
from martloom.operators.writes import first_per_key, new_rows, upsert_last_wins


def read_landed(spark: SparkSession, location: str) -> DataFrame:
    """One JSON text per line, as ``content``."""
    return spark.read.text(location).withColumnRenamed("value", "content")


def document_batch(source: DataFrame, state: DataFrame, collection: str, run_id: int, start=None):
    """Documents updated after the stored time, and what makes the state row of a loaded batch.

    The first run takes everything, or what was updated after ``start`` if the caller gives one.
    """
    last = load_state.read(state, "stg", "documents", collection) or start
    batch = source if last is None else source.where(F.col("update_ts") > F.lit(last).cast("timestamp_ntz"))
    return batch, lambda loaded: load_state.progress(loaded, "stg", "documents", collection, F.col("update_ts"), run_id)


def latest_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per document, the one updated last."""
    return upsert_last_wins(old, new, ["object_id"], ["update_ts", "object_value"])


def documents_increment(
    source: DataFrame, loaded: DataFrame, state: DataFrame, collection: str, run_id: int, start=None,
) -> tuple[DataFrame, DataFrame]:
    """A load as one step on whole tables: (new target, new state); later versions win."""
    batch, moved = document_batch(source, state, collection, run_id, start)
    return latest_versions(loaded, batch), load_state.advance(state, moved(batch))


LANDED = "content_key string, content string, load_ts timestamp_ntz"


def api_snapshot(landed: DataFrame, loaded: DataFrame, load_ts: Column) -> DataFrame:
    """Payload rows (``LANDED``) whose content is not loaded yet.

    Contents are compared by their digest, so the loaded texts are not read again.
    """
    stamped = landed.withColumns({"content_key": F.sha2("content", 256), "load_ts": load_ts})
    return new_rows(loaded, stamped, ["content_key"], [F.col("load_ts")]).select(loaded.columns)


def api_increment(
    landed: DataFrame, loaded: DataFrame, state: DataFrame, run_id: int, load_ts: Column,
    table: str = "api_deliveries",
) -> tuple[DataFrame, DataFrame]:
    """Payload rows from the stored ``delivery_ts`` on (whole seconds), and the new state.

    The stored second is read again, since it may have been cut inside; rows
    already loaded are recognised by their content.  The first run loads everything.
    """
    last = load_state.read(state, "stg", "api", table)
    delivered = F.to_timestamp_ntz(F.get_json_object("content", "$.delivery_ts"))
    batch = landed.withColumn("__at", delivered)
    if last is not None:
        since = F.lit(last).cast("timestamp_ntz")
        batch = batch.where(F.col("__at") >= since)
        # What is known by content need only be looked for among rows loaded from that second on.
        loaded = loaded.where(delivered >= since)
    second = F.date_trunc("second", F.col("__at")).cast("timestamp_ntz")
    moved = load_state.progress(batch, "stg", "api", table, second, run_id)
    fresh = api_snapshot(batch.drop("__at"), loaded, load_ts)
    return fresh, load_state.advance(state, moved)


def parse_envelopes(messages: DataFrame) -> DataFrame:
    """Mixed message texts (column ``value``) to envelope columns; the payload stays text."""
    return with_parsed(messages, "value", schemas.ENVELOPE, keep=[])


def envelope_rejects(messages: DataFrame, known: tuple[str, ...] = ("CURRENCY", "TRANSACTION")) -> DataFrame:
    """Envelopes the router cannot use, with the reason: broken texts, missing fields, unknown object types."""
    unusable = json_rejects(messages, "value", schemas.ENVELOPE, ["object_type", "payload"])
    kind = F.get_json_object("value", "$.object_type")
    other = messages.where(~kind.isin(*known)).join(
        unusable.select("value").distinct(), "value", "left_anti").withColumn("reason", F.lit("unknown type"))
    return unusable.unionByName(other.select(unusable.columns))


def envelope_rows(envelopes: DataFrame, object_type: str, schema: str, load_src: str, load_dt: Column) -> DataFrame:
    """Payload rows of one object type with lineage columns."""
    return (
        envelopes.where(F.col("object_type") == object_type)
        .select(F.from_json("payload", schema, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}).alias("p"))
        .select("p.*", load_dt.alias("load_dt"), F.lit(load_src).alias("load_src"))
    )


def currencies_from(envelopes: DataFrame, load_dt: Column) -> DataFrame:
    return envelope_rows(envelopes, "CURRENCY", schemas.CURRENCIES, "Kafka-currency", load_dt)


def transactions_from(envelopes: DataFrame, load_dt: Column) -> DataFrame:
    return envelope_rows(envelopes, "TRANSACTION", schemas.TRANSACTIONS, "Kafka-transaction", load_dt)


# Object type of an envelope -> table, schema of its payload, source name, fields a row needs.
ROUTES = {
    "CURRENCY": ("currencies", schemas.CURRENCIES, "Kafka-currency", ["date_update", "currency_code", "currency_code_with"]),
    "TRANSACTION": ("transactions", schemas.TRANSACTIONS, "Kafka-transaction", ["operation_id", "transaction_dt"]),
}


def checked_envelopes(messages: DataFrame) -> DataFrame:
    """Envelope columns of every message, with its text and the ``reason`` of those the router cannot use."""
    checked = with_checked(messages.select("value"), "value", schemas.ENVELOPE, ["object_type", "payload"])
    other = F.when(~F.col("object_type").isin(*ROUTES), F.lit("unknown type"))
    return checked.withColumn("reason", F.coalesce("reason", other))


def routed(checked: DataFrame, load_dt: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows of each table with lineage, and the rejects (value, reason).

    A payload that is broken or lacks a field it needs rejects its envelope: ``payload broken``, ``payload missing <field>``.
    """
    rows: dict[str, DataFrame] = {}
    rejects = checked.where("reason is not null").select("value", "reason")
    for kind, (table, schema, load_src, required) in ROUTES.items():
        payloads = checked.where((F.col("object_type") == kind) & F.col("reason").isNull()).select("value", "payload")
        parsed = with_checked(payloads, "payload", schema, required, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"})
        rows[table] = parsed.where("reason is null").drop("value", "payload", "reason").withColumns(
            {"load_dt": load_dt, "load_src": F.lit(load_src)})
        rejects = rejects.unionByName(parsed.where("reason is not null").select(
            "value", F.concat(F.lit("payload "), F.col("reason")).alias("reason")))
    return rows, rejects


def latest_documents(documents: DataFrame) -> DataFrame:
    """Newest version per document id."""
    return first_per_key(documents, ["object_id"], [F.desc("update_ts"), F.desc("object_value")])
