"""Whole jobs: read the sources, bring the tables up to date, publish the marts.

A job may be repeated at any point: targets are published before the load
state moves on, inserts skip what is there, and marts are overwritten.
Locations are folders; every mart has its own below ``out``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.operators import state as load_state
from martloom.plans import couriers, geo_marts, messenger, metrics, order_vault, settlement
from martloom.session import stored, work_folders_removed
from martloom.sources import buckets, documents, events, files, relational, tables
from martloom.sources.buckets import BucketTable
from martloom.streaming import campaigns, flow


# Tables of a job that are written at the same time.
WRITERS = 6
# Buckets of a campaign's audience.
AUDIENCE_BUCKETS = 64


def _existing(spark: SparkSession, location: str, like: DataFrame) -> DataFrame:
    found = tables.latest(spark, location)
    return tables.empty_like(like) if found is None else found


def _side_by_side(write: Callable[[str], None], names: Iterable[str]) -> None:
    """Write independent tables at the same time: small writes leave executors idle.  The first error is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(copy_context().run, write, name) for name in names]:
            done.result()


def _state(spark: SparkSession, out: str) -> DataFrame:
    found = tables.latest(spark, f"{out}/load_state")
    return load_state.empty(spark) if found is None else found


# --- settlement and couriers ------------------------------------------------------------

DOCUMENT = "object_id string, object_value string, update_ts timestamp_ntz"


def load_documents(spark: SparkSession, landing: str, out: str, collection: str, run_id: int, start=None) -> DataFrame:
    """Landed documents of a collection -> ``out/<collection>``, last version wins.

    The first run takes all documents, or those updated after ``start``.  Only the buckets of the new documents are
    rewritten.  ``out/<collection>_log`` keeps every version, a folder per run (``loaded_run``).
    """
    source = spark.read.schema(DOCUMENT).json(landing)
    old_state = _state(spark, out)
    batch, moved = documents.document_batch(source, old_state, collection, run_id, start)
    tables.append_batch(batch, f"{out}/{collection}_log", run_id)
    batch = loaded_run(spark, out, collection, run_id)
    table = _collection(spark, out, collection)
    buckets.upsert(table, batch, lambda old, new: documents.latest_versions(old, new))
    tables.publish(stored(load_state.advance(old_state, moved(batch)), "load_state"), f"{out}/load_state")
    return table.read()


def loaded_run(spark: SparkSession, out: str, collection: str, run_id: int) -> DataFrame:
    """All document versions that a run has loaded."""
    return spark.read.schema(DOCUMENT).parquet(f"{out}/{collection}_log/batch_id={run_id}")


def _collection(spark: SparkSession, out: str, collection: str) -> buckets.BucketTable:
    return buckets.BucketTable(spark, f"{out}/{collection}", ["object_id"], DOCUMENT)


def product_tables(spark: SparkSession, out: str, like: DataFrame) -> tuple[buckets.BucketTable, buckets.BucketTable]:
    """(all stated menu items, their versions), both in buckets of the product."""
    versions = settlement.product_versions(like.limit(0))
    return (buckets.BucketTable(spark, f"{out}/dm_products_stated", settlement.PRODUCT, like.schema),
            buckets.BucketTable(spark, f"{out}/dm_products", settlement.PRODUCT, versions.schema))


def update_products(restaurants: DataFrame, out: str) -> DataFrame:
    """Bring the stored product history up to date with new restaurant documents, in any order of time.

    What a menu stated at a moment is kept, since a late document may come between two equal ones.  Only the
    products of the new documents get new intervals; other products of their buckets are copied, other buckets not
    touched.  Documents may be repeated.  Returns the whole dimension.
    """
    spark = restaurants.sparkSession
    items = stored(settlement.menu_items(restaurants).distinct(), "menu_items")
    stated, versions = product_tables(spark, out, items)
    touched = stated.touched(items)
    if touched:
        stated.replace(stated.read(touched).unionByName(items).distinct(), touched)
        both = stated.read(touched)
        products = items.select(*settlement.PRODUCT).distinct()
        fresh = settlement.product_versions(both.join(products, settlement.PRODUCT, "left_semi"))
        others = versions.read(touched).join(products, settlement.PRODUCT, "left_anti")
        versions.replace(others.unionByName(fresh), touched)
    return versions.read()


def update_restaurants(restaurants: DataFrame, out: str) -> DataFrame:
    """Bring the stored restaurant dimension up to date: the first start and the last name of each."""
    fresh = settlement.dim_restaurants(restaurants)
    schema = fresh.withColumn("updated", F.col("active_from")).schema
    table = buckets.BucketTable(restaurants.sparkSession, f"{out}/dm_restaurants", ["restaurant_id"], schema)
    buckets.upsert(table, fresh, lambda old, new: settlement.merged_restaurants(old, new, restaurants))
    return table.read().drop("updated")


def settlement_job(users: DataFrame, restaurants: DataFrame, orders: DataFrame, outbox: DataFrame, out: str, as_of) -> None:
    """Staged documents and bonus events -> dimensions, fact and settlement report.

    ``restaurants`` may be the whole log of documents or only what is new: products and restaurants are kept as
    tables that each run extends.
    """
    settled = stored(settlement.settled_orders(orders), "settled_orders")
    spark = settled.sparkSession
    made = {
        "dm_users": settlement.dim_users(users),
        "dm_timestamps": settlement.dim_timestamps(settled),
        "dm_orders": settlement.dim_orders(settled),
    }
    for name, df in made.items():
        tables.overwrite(df, f"{out}/{name}")
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    tables.overwrite(
        settlement.fact_product_sales(settled, outbox, update_products(restaurants, out)), f"{out}/fct_product_sales")
    tables.overwrite(
        settlement.settlement_report(
            read("fct_product_sales"), read("dm_orders"), read("dm_timestamps"), update_restaurants(restaurants, out), as_of),
        f"{out}/dm_settlement_report")


def courier_job(courier_content: DataFrame, delivery_content: DataFrame, out: str, floor_per: str = "month") -> None:
    """Landed courier and delivery texts -> dimensions, fact and courier ledger."""
    tables.overwrite(couriers.delivery_rejects(delivery_content), f"{out}/deliveries_rej")
    deliveries = stored(couriers.parse_deliveries(delivery_content), "deliveries")
    spark = deliveries.sparkSession
    made = {
        "dm_api_couriers": couriers.dim_couriers(couriers.parse_couriers(courier_content), deliveries),
        "dm_api_address": couriers.dim_addresses(deliveries),
        "dm_api_orders": couriers.dim_delivery_orders(deliveries),
        "dm_api_delivery_details": couriers.dim_deliveries(deliveries),
        "fct_api_sales": couriers.fact_deliveries(deliveries),
    }
    for name, df in made.items():
        tables.overwrite(df, f"{out}/{name}")
    tables.overwrite(
        couriers.courier_ledger(
            spark.read.parquet(f"{out}/fct_api_sales"), spark.read.parquet(f"{out}/dm_api_couriers"), floor_per),
        f"{out}/dm_courier_ledger")


# --- messenger ---------------------------------------------------------------------------

def load_messenger_csv(spark: SparkSession, location: str, out: str) -> dict[str, DataFrame]:
    """Four delimited files -> typed staging tables, with the bad lines beside them."""
    layouts = {
        "users": schemas.USERS, "groups": schemas.GROUPS, "dialogs": schemas.DIALOGS, "group_log": schemas.GROUP_LOG}
    for name, schema in layouts.items():
        loaded = files.load_csv(spark, f"{location}/{name}.csv", schema)
        tables.overwrite(files.good_rows(loaded), f"{out}/{name}")
        tables.overwrite(files.rejected_rows(loaded), f"{out}/{name}_rej")
    return {name: spark.read.parquet(f"{out}/{name}") for name in layouts}


def messenger_job(stage: dict[str, DataFrame], out: str, load_dt, batch_id: int) -> None:
    """Staging -> vault and group conversion.  Hubs and links are insert-only, satellites are replaced."""
    vault = messenger.messenger_vault(
        stage["users"], stage["groups"], stage["dialogs"], stage["group_log"], load_dt)
    spark = stage["users"].sparkSession
    def write(name: str) -> None:
        df = vault[name]
        if name.startswith("sat_"):
            tables.overwrite(df, f"{out}/{name}")
        else:
            buckets.append_new(df, f"{out}/{name}", [df.columns[0]], batch_id)

    _side_by_side(write, vault)
    kept = {name: spark.read.parquet(f"{out}/{name}") for name in vault}
    tables.overwrite(messenger.group_conversion(kept), f"{out}/group_conversion")


# --- geo -----------------------------------------------------------------------------------

def geo_job(spark: SparkSession, events_location: str, zones_location: str, out: str, processed_dttm, home_days: int = 27) -> None:
    """Event log and zone file -> user, visit, zone and friend marts."""
    log = events.with_event_id(events.scan_events(spark, events_location))
    zones = events.geo_dimension(spark.read.parquet(zones_location))
    tables.overwrite(geo_marts.user_geo_stats(log, zones, home_days), f"{out}/user_geo_stats")
    tables.overwrite(geo_marts.user_visits(log, zones), f"{out}/user_visits")
    tables.overwrite(geo_marts.zone_stats(log, zones), f"{out}/zone_stats")
    tables.overwrite(
        geo_marts.friend_recommendations(log, zones, processed_dttm), f"{out}/friend_recommendations")


# --- order events ----------------------------------------------------------------------------

def order_job(messages: DataFrame, users: DataFrame, restaurants: DataFrame, out: str, load_dt, batch_id: int) -> None:
    """A batch of order messages -> vault rows not there yet, counters brought up to date, rejects.

    The counters are sums of one delta per batch, counted from the triples no
    earlier batch has brought: earlier order lines are not read.  Every write
    goes to the batch's own folder, so repeating a batch changes nothing.
    """
    spark = messages.sparkSession
    with work_folders_removed(spark):
        tables.append_batch(order_vault.order_rejects(messages), f"{out}/orders_rej", batch_id)
        raw = order_vault.parse_order_events(messages)
        lines = stored(order_vault.order_lines(order_vault.enrich_orders(raw, users, restaurants)), "order_lines")
        vault = order_vault.order_vault(lines, load_dt)

        def count(by: str) -> None:
            triples, keys = order_vault.counted_triples(lines, by)
            buckets.append_new(triples, f"{out}/{by}_orders", keys, batch_id)
            new = spark.read.schema(triples.schema).parquet(f"{out}/{by}_orders/batch_id={batch_id}")
            tables.append_batch(order_vault.counter_deltas(new, by), f"{out}/{by}_deltas", batch_id)
            tables.overwrite(
                order_vault.summed_counters(spark.read.parquet(f"{out}/{by}_deltas"), by), f"{out}/user_{by}_counters")

        def write(name: str) -> None:
            if name in vault:
                buckets.append_new(vault[name], f"{out}/{name}", [order_vault.primary_key(name)], batch_id)
            else:
                count(name)

        _side_by_side(write, ["product", "category", *vault])


# --- incremental loads ----------------------------------------------------------------------------

def _appended(spark: SparkSession, location: str, like: DataFrame) -> DataFrame:
    """Rows of an appended table so far."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    there = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    return spark.read.schema(like.schema).parquet(location).select(like.columns) if there else tables.empty_like(like)


def outbox_job(source: DataFrame, out: str, run_id: int) -> None:
    """Outbox rows above the stored id -> ``out/events``; the state moves after the rows are there."""
    spark = source.sparkSession
    with work_folders_removed(spark):
        fresh, state = relational.outbox_increment(
            source, _appended(spark, f"{out}/events", source), _state(spark, out), run_id)
        state = stored(state, "load_state")
        tables.append_batch(fresh, f"{out}/events", run_id)
        tables.publish(state, f"{out}/load_state")


def api_job(landed: DataFrame, out: str, run_id: int, load_ts, snapshot: bool = False) -> None:
    """Landed payload texts -> ``out/payloads``: a snapshot by content, or deliveries from the stored second on."""
    spark = landed.sparkSession
    stamp = F.lit(load_ts).cast("timestamp_ntz")
    with work_folders_removed(spark):
        loaded = _appended(spark, f"{out}/payloads", spark.createDataFrame([], documents.LANDED))
        if snapshot:
            tables.append_batch(documents.api_snapshot(landed, loaded, stamp), f"{out}/payloads", run_id)
            return
        fresh, state = documents.api_increment(landed, loaded, _state(spark, out), run_id, stamp)
        state = stored(state, "load_state")
        tables.append_batch(fresh, f"{out}/payloads", run_id)
        tables.publish(state, f"{out}/load_state")


def day_slices_job(source: DataFrame, column: str, out: str, until, since=None) -> None:
    """Whole days of a relation -> ``out``, each replacing itself; repeating a run changes nothing."""
    tables.replace_slices(relational.day_slices(source, column, until, since), out, "load_day")


def campaign_job(
    messages: DataFrame, subscribers: DataFrame, out: str, *sinks, now: int | None = None, every: str | None = None,
    buckets: int = AUDIENCE_BUCKETS,
):
    """Offer stream -> subscribers' notifications in all sinks, with a checkpoint below ``out``.

    Each start writes the audience once, one row per client and restaurant, in ``buckets`` by restaurant
    (the number is fixed by the first start); a micro-batch reads those of its restaurants.
    """
    rows = campaigns.static_subscribers(subscribers).select("client_id", "restaurant_id")
    audience = BucketTable(subscribers.sparkSession, f"{out}/audience", ["restaurant_id"], rows.schema, buckets)
    audience.replace(rows, range(buckets))
    offers = campaigns.first_offers(campaigns.active_campaigns(campaigns.parse_campaigns(messages), now))
    return flow.start(offers, campaigns.to_audience(audience, flow.fan_out(*sinks)), f"{out}/checkpoint", every=every)


def campaign_rejects_job(messages: DataFrame, out: str, every: str | None = None):
    """Campaign messages that cannot be used -> ``out/rejects``; a stream beside ``campaign_job``, with its own checkpoint."""
    return flow.start(
        campaigns.campaign_rejects(messages), flow.table_sink(f"{out}/rejects"), f"{out}/checkpoint_rejects", every=every)


def envelope_job(messages: DataFrame, out: str, load_dt, batch_id: int) -> None:
    """A batch of mixed envelopes -> ``out/currencies``, ``out/transactions`` and ``out/envelopes_rej``, each with a reason.

    Every write goes to the batch's own folder, so repeating a batch changes nothing.
    """
    with work_folders_removed(messages.sparkSession):
        checked = stored(documents.checked_envelopes(messages), "envelopes")
        rows, rejects = documents.routed(checked, F.lit(load_dt).cast("timestamp_ntz"))
        parts = {**rows, "envelopes_rej": rejects}
        _side_by_side(lambda name: tables.append_batch(parts[name], f"{out}/{name}", batch_id), parts)


# --- metrics -----------------------------------------------------------------------------------

def load_new_files(spark: SparkSession, location: str, out: str, table: str, schema: str, load_dt, batch_id: int, columns: list[str] | None = None) -> None:
    """Files of a table that are new or touched since the last run -> ``out/<table>``; read it by ``loaded_files``.

    Their bad lines go to ``out/<table>_rej``, with the file.
    """
    found = stored(files.list_files(spark, location, table), "found_files")
    manifest = tables.latest(spark, f"{out}/{table}_manifest")
    selected = files.files_to_load(found, manifest)
    rows = files.load_files(spark, location, schema, selected, F.lit(load_dt).cast("timestamp_ntz"), columns=columns)
    tables.append_batch(rows, f"{out}/{table}", batch_id)
    tables.append_batch(files.rejected_lines(spark, schema, selected), f"{out}/{table}_rej", batch_id)
    tables.publish(files.updated_manifest(found, manifest), f"{out}/{table}_manifest")


def loaded_files(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The rows of a table loaded from files, those of each file's latest reading."""
    return files.newest_files(spark.read.parquet(f"{out}/{table}"))


def metrics_job(
    transactions: DataFrame, currencies: DataFrame, out: str, load_dt, run_id: int,
    base_currency: int = metrics.BASE_CURRENCY, mode: str = "insert",
) -> None:
    """Transactions loaded since the last run -> ``out/global_metrics``.

    ``upsert`` replaces the days those transactions belong to by whole ones, without reading earlier transactions:
    partial sums per (day, currency, account) are kept in ``out/global_metrics_state`` and merged.
    A part is named by the position it starts from, so a run that died half-way replaces its part when it is repeated.
    """
    spark = transactions.sparkSession
    state = _state(spark, out)
    with work_folders_removed(spark):
        if mode == "upsert":
            fresh, moved = _metrics_from_state(spark, transactions, currencies, out, load_dt, run_id, state, base_currency)
        else:
            since = load_state.read(state, "dwh", "stg", "global_metrics")
            fresh = metrics.daily_metrics(transactions, currencies, load_dt, base_currency, loaded_after=since)
            increment = transactions if since is None else transactions.where(
                F.col("load_dt") > F.lit(since).cast("date").cast("timestamp_ntz"))
            moved = load_state.progress(increment, "dwh", "stg", "global_metrics", F.to_date("load_dt"), run_id)
        state = stored(load_state.advance(state, moved), "load_state")
        existing = _existing(spark, f"{out}/global_metrics", fresh)
        tables.publish(metrics.merge_metrics(existing, fresh, mode), f"{out}/global_metrics")
        tables.publish(state, f"{out}/load_state")


def _metrics_from_state(
    spark: SparkSession, transactions: DataFrame, currencies: DataFrame, out: str, load_dt, run_id: int,
    state: DataFrame, base_currency: int,
) -> tuple[DataFrame, DataFrame]:
    """(whole days that the new transactions touch, load-state row)."""
    name = ("dwh", "stg", "global_metrics_state")
    since = load_state.read(state, *name)
    increment = transactions if since is None else transactions.where(
        F.col("load_dt") > F.lit(since).cast("timestamp_ntz"))
    start = 0 if since is None else int(datetime.fromisoformat(since).replace(tzinfo=timezone.utc).timestamp() * 1e6)
    parts = stored(metrics.day_state(increment), "metric_parts")
    kept = BucketTable(spark, f"{out}/global_metrics_state", metrics.KEYS, metrics.STATE)
    kept.append(parts, start)
    days = parts.select(*metrics.KEYS).distinct()
    whole = kept.read(kept.touched(days)).join(days, metrics.KEYS, "left_semi")
    fresh = metrics.in_base_currency(metrics.merged_days(whole), currencies, load_dt, base_currency)
    return fresh, load_state.progress(increment, *name, F.col("load_dt"), run_id)
