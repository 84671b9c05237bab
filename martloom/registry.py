"""Named queries: each job and operator over the driver's tables.

A query returns plain columns: decimals as doubles, arrays as joined text.
Those that store something do so in a fresh folder (``work_dir``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martloom import schemas
from martloom.bindings import AS_OF, CAMPAIGN_NOW, LOAD_DT, Inputs
from martloom.functions.keys import uuid3
from martloom.functions.text import document_id, with_document
from martloom.operators import state as load_state
from martloom.operators.joins import orphans
from martloom.operators.nearest import nearest_zone, nearest_zones
from martloom.operators.pairs import channel_members, channel_pairs, contact_pairs, never_contacted
from martloom.operators.writes import (
    additive_upsert, insert_if_absent, merge_insert_only, upsert_last_wins)
from martloom.plans import couriers, geo_marts, jobs, messenger, metrics, order_vault, settlement
from martloom.session import stored, work_dir
from martloom.sources import buckets, documents, events, files, relational, tables
from martloom.streaming import campaigns, flow, orders

SPLIT_DATE = "1998-01-01"
WITHIN_KM = 1.0
DISTANCE_DIGITS = 6
# Files that a stream reads together where one would do: compressed texts are read by a task each.
PARTS = 8
VAULT_B = [
    "hub_users", "hub_messages", "hub_groups", "link_admins", "link_user_message", "link_group_message",
    "link_user_group", "sat_admins", "sat_dialog", "sat_socdem", "sat_chatinfo", "sat_group_name",
    "sat_group_private", "sat_auth_history"]
VAULT_E = [
    "h_user", "h_product", "h_category", "h_restaurant", "h_order", "l_order_product", "l_product_restaurant",
    "l_product_category", "l_order_user", "s_order_cost", "s_order_status", "s_product_names",
    "s_restaurant_names", "s_user_names"]

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def _query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Columns of types that compare the same everywhere."""
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(*out)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(fn(Inputs(spark, sf_dir)))
    return {name: bind(fn) for name, fn in _QUERIES.items()}


def _zones(i: Inputs) -> DataFrame:
    return events.geo_dimension(i.geo_raw)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_km", F.round("distance_km", DISTANCE_DIGITS))


# --- settlement and couriers ---------------------------------------------------

def _delivery_tables(i: Inputs) -> tuple[DataFrame, DataFrame]:
    deliveries = couriers.parse_deliveries(i.delivery_content)
    dim = couriers.dim_couriers(couriers.parse_couriers(i.courier_content), deliveries)
    return deliveries, dim


def _ledger_inputs(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Fact and dimension from the landed JSON texts, which are parsed once for both."""
    deliveries = stored(couriers.parse_deliveries(i.delivery_content), "deliveries")
    dim = couriers.dim_couriers(couriers.parse_couriers(i.courier_content), deliveries)
    return couriers.fact_deliveries(deliveries), dim


@_query
def courier_ledger(i: Inputs) -> DataFrame:
    return couriers.courier_ledger(*_ledger_inputs(i))


@_query
def courier_ledger_order_floor(i: Inputs) -> DataFrame:
    return couriers.courier_ledger(*_ledger_inputs(i), floor_per="order")


@_query
def courier_monthly(i: Inputs) -> DataFrame:
    return couriers.courier_monthly(couriers.fact_deliveries(_delivery_tables(i)[0])).select(
        "courier_id", "year", "month", "orders_count", "orders_total_sum", "tip_sum", "rate")


@_query
def late_courier_members(i: Inputs) -> DataFrame:
    return _delivery_tables(i)[1].where(F.col("name").startswith(couriers.PLACEHOLDER_PREFIX))


@_query
def dim_couriers(i: Inputs) -> DataFrame:
    return _delivery_tables(i)[1]


@_query
def dim_delivery_restaurants(i: Inputs) -> DataFrame:
    landed = i.table("customer").select(F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("_id"), F.col("c_name").alias("name"))).alias("content"))
    return couriers.parse_restaurants(landed)


@_query
def dim_addresses(i: Inputs) -> DataFrame:
    return couriers.dim_addresses(_delivery_tables(i)[0])


@_query
def dim_delivery_orders(i: Inputs) -> DataFrame:
    return couriers.dim_delivery_orders(_delivery_tables(i)[0])


@_query
def dim_deliveries(i: Inputs) -> DataFrame:
    return couriers.dim_deliveries(_delivery_tables(i)[0])


@_query
def fact_deliveries(i: Inputs) -> DataFrame:
    return couriers.fact_deliveries(_delivery_tables(i)[0])


@_query
def unmatched_keys(i: Inputs) -> DataFrame:
    """Keys of the delivery fact that no dimension has before placeholders are added."""
    deliveries = stored(couriers.parse_deliveries(i.delivery_content), "deliveries")
    known = couriers.parse_couriers(i.courier_content).select(uuid3("courier_id").alias("courier_id"))
    return orphans(couriers.fact_deliveries(deliveries), {
        "courier_id": known,
        "order_id": couriers.dim_delivery_orders(deliveries).select(F.col("id").alias("order_id")),
        "delivery_id": couriers.dim_deliveries(deliveries).select(F.col("id").alias("delivery_id"))})


@_query
def dim_users(i: Inputs) -> DataFrame:
    return settlement.dim_users(i.user_documents)


@_query
def dim_restaurants(i: Inputs) -> DataFrame:
    return settlement.dim_restaurants(i.restaurant_documents)


@_query
def dim_timestamps(i: Inputs) -> DataFrame:
    return settlement.dim_timestamps(settlement.settled_orders(i.order_documents))


@_query
def dim_products_scd2(i: Inputs) -> DataFrame:
    return settlement.dim_products(i.restaurant_documents)


@_query
def dim_orders(i: Inputs) -> DataFrame:
    return settlement.dim_orders(settlement.settled_orders(i.order_documents))


@_query
def fact_product_sales(i: Inputs) -> DataFrame:
    return settlement.fact_product_sales(settlement.settled_orders(i.order_documents), i.outbox)


@_query
def product_history_increments(i: Inputs) -> DataFrame:
    """The product history by three loads of mixed age into stored tables; many documents come late."""
    log = i.restaurant_documents
    out = work_dir(log.sparkSession, "history")
    part = F.pmod(F.xxhash64("object_id", "update_ts"), F.lit(3))
    for load in range(3):
        history = jobs.update_products(log.where(part == load), out)
    return history


@_query
def fact_product_versions(i: Inputs) -> DataFrame:
    """Fact lines with the product version valid at the order's time; orders are moved to the menus' years."""
    products = stored(settlement.dim_products(i.restaurant_documents), "products")
    settled = settlement.settled_orders(i.order_documents).withColumn("ts", F.expr("timestampadd(YEAR, 26, ts)"))
    fact = settlement.fact_product_sales(settled, i.outbox, products)
    versions = products.select(F.col("id").alias("product_id"), F.col("product_id").alias("product_key"), "active_from")
    return fact.join(versions, "product_id").select("order_id", "product_key", "count", "active_from")


@_query
def settlement_report(i: Inputs) -> DataFrame:
    settled = stored(settlement.settled_orders(i.order_documents), "settled_orders")
    return settlement.settlement_report(
        settlement.fact_product_sales(settled, i.outbox),
        settlement.dim_orders(settled),
        settlement.dim_timestamps(settled),
        settlement.dim_restaurants(i.restaurant_documents), AS_OF)


# --- messenger -------------------------------------------------------------------

def _messenger(i: Inputs, store_parents: bool = False) -> dict[str, DataFrame]:
    return messenger.messenger_vault(i.users, i.groups, i.dialogs, i.group_log, LOAD_DT, store_parents=store_parents)


@_query
def event_changes(i: Inputs) -> DataFrame:
    return messenger.event_changes(i.group_log)


for _name in VAULT_B:
    _QUERIES[f"vault_{_name}"] = lambda i, name=_name: _messenger(i)[name]


@_query
def vault_rerun_no_double(i: Inputs) -> DataFrame:
    """A hub loaded for some users, then for all, then for all again: every key is there once."""
    where = work_dir(i.spark, "hub")
    early = i.users.where(F.col("registration_dt") < F.lit("2021-06-01").cast("timestamp_ntz"))
    for batch, users in enumerate((early, i.users, i.users)):
        vault = messenger.messenger_vault(users, i.groups, i.dialogs, i.group_log, LOAD_DT)
        buckets.append_new(vault["hub_users"], where, ["hk_user_id"], batch)
    return i.spark.read.parquet(where).drop("batch_id")


@_query
def oldest_groups(i: Inputs) -> DataFrame:
    return messenger.oldest_groups(_messenger(i)["hub_groups"])


@_query
def oldest_groups_semi(i: Inputs) -> DataFrame:
    v = _messenger(i)
    return messenger.group_added_users(
        v["sat_auth_history"], v["link_user_group"], messenger.oldest_groups(v["hub_groups"]))


@_query
def group_added_users(i: Inputs) -> DataFrame:
    v = _messenger(i)
    return messenger.group_added_users(v["sat_auth_history"], v["link_user_group"])


@_query
def group_active_users(i: Inputs) -> DataFrame:
    v = _messenger(i)
    return messenger.group_active_users(v["link_group_message"], v["link_user_message"])


@_query
def group_conversion(i: Inputs) -> DataFrame:
    return messenger.staged_group_conversion(i.users, i.groups, i.dialogs, i.group_log)


@_query
def group_conversion_members(i: Inputs) -> DataFrame:
    return messenger.staged_group_conversion(i.users, i.groups, i.dialogs, i.group_log, members_only=True)


# --- geo -------------------------------------------------------------------------

@_query
def geo_dimension(i: Inputs) -> DataFrame:
    return _zones(i)


@_query
def scan_events(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "events")
    tables.overwrite(i.geo_events, where, ["event_type"])
    return events.scan_events(i.spark, where, "message").select(
        "event_id", "event.message_from", "event.message_to", "lat", "lon", "date")


@_query
def mart_overwrite_roundtrip(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "mart")
    counts = i.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    tables.overwrite(counts.withColumn("events", F.lit(0).cast("long")), where)
    tables.overwrite(counts, where)
    return i.spark.read.parquet(where)


@_query
def geo_nearest_city(i: Inputs) -> DataFrame:
    return _rounded(geo_marts.located_messages(i.geo_events, _zones(i)).select(
        "event_id", "user_id", "ts", "zone_id", "city", "timezone", "distance_km"))


@_query
def geo_nearest_rank(i: Inputs) -> DataFrame:
    """The three nearest zones of every placed event, by rank."""
    points = geo_marts.last_known_location(i.geo_events).where("m_lat is not null").select("event_id", "m_lat", "m_lng")
    return _rounded(nearest_zones(points, _zones(i), 3, "m_lat", "m_lng").select("event_id", "zone_id", "distance_km", "rank"))


@_query
def geo_nearest_grid(i: Inputs) -> DataFrame:
    """The search used for zone lists beyond the array bound."""
    points = geo_marts.last_known_location(i.geo_events).where("m_lat is not null").select("event_id", "m_lat", "m_lng")
    return _rounded(nearest_zone(points, _zones(i), "m_lat", "m_lng", max_array_zones=0).select(
        "event_id", "zone_id", "city", "distance_km"))


@_query
def last_known_location(i: Inputs) -> DataFrame:
    return geo_marts.last_known_location(i.geo_events).select("event_id", "user_id", "m_lat", "m_lng")


def _stays(i: Inputs) -> DataFrame:
    columns = ["user_id", "event_id", "ts", "city"]
    located = stored(geo_marts.located_messages(i.geo_events, _zones(i)).select(*columns), "located_messages")
    return geo_marts.city_stays(stored(geo_marts.city_arrivals(located), "city_arrivals"), located)


@_query
def city_stays(i: Inputs) -> DataFrame:
    return _stays(i)


@_query
def home_city(i: Inputs) -> DataFrame:
    return geo_marts.home_city(_stays(i)).select("user_id", "home_city")


@_query
def travel_history(i: Inputs) -> DataFrame:
    return geo_marts.travel_history(_stays(i)).select("user_id", "visit_no", "city", "ts")


@_query
def actual_city(i: Inputs) -> DataFrame:
    return geo_marts.actual_city(geo_marts.located_messages(i.geo_events, _zones(i)))


@_query
def user_geo_stats(i: Inputs) -> DataFrame:
    return geo_marts.user_geo_stats(i.geo_events, _zones(i))


@_query
def registrations(i: Inputs) -> DataFrame:
    return geo_marts.registrations(geo_marts.user_zone_days(
        geo_marts.located_events(i.geo_events, _zones(i)))).drop("day")


def _zone_days(i: Inputs) -> DataFrame:
    return geo_marts.zone_counts_daily(geo_marts.user_zone_days(
        geo_marts.located_events(i.geo_events, _zones(i))))


@_query
def zone_counts_week(i: Inputs) -> DataFrame:
    return geo_marts.zone_counts(_zone_days(i), "week")


@_query
def zone_counts_month(i: Inputs) -> DataFrame:
    return geo_marts.zone_counts(_zone_days(i), "month")


@_query
def zone_stats(i: Inputs) -> DataFrame:
    return geo_marts.zone_stats(i.geo_events, _zones(i))


@_query
def final_coordinates(i: Inputs) -> DataFrame:
    return geo_marts.final_coordinates(i.geo_events)


@_query
def contact_pairs_(i: Inputs) -> DataFrame:
    return contact_pairs(i.geo_events)


@_query
def channel_members_(i: Inputs) -> DataFrame:
    return channel_members(i.geo_events)


def _near_pairs(i: Inputs) -> DataFrame:
    return channel_pairs(channel_members(i.geo_events), geo_marts.final_coordinates(i.geo_events), WITHIN_KM)


@_query
def channel_pairs_(i: Inputs) -> DataFrame:
    return _rounded(_near_pairs(i))


@_query
def pairs_never_contacted(i: Inputs) -> DataFrame:
    return never_contacted(_near_pairs(i), contact_pairs(i.geo_events)).select("user_1", "user_2")


@_query
def friend_recommendations(i: Inputs) -> DataFrame:
    return geo_marts.friend_recommendations(i.geo_events, _zones(i), LOAD_DT)


for _name in ("contact_pairs", "channel_members", "channel_pairs"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_")


# --- order events ------------------------------------------------------------------

def _enriched(i: Inputs) -> DataFrame:
    raw = order_vault.parse_order_events(i.order_events)
    return order_vault.enrich_orders(raw, i.user_entries, i.restaurant_entries)


@_query
def order_enrichment(i: Inputs) -> DataFrame:
    return order_vault.order_lines(_enriched(i)).select(
        "order_id", "order_dt", "cost", "payment", "status", "user_id", "username", "userlogin",
        "restaurant_id", "restaurant_name", "product_id", "product_name", "category_name", "quantity")


def _order_vault(i: Inputs) -> dict[str, DataFrame]:
    enriched = _enriched(i)
    return order_vault.order_vault(order_vault.order_lines(enriched), LOAD_DT, rows=order_vault.order_rows(enriched))


for _name in VAULT_E:
    _QUERIES[f"vault2_{_name}"] = lambda i, name=_name: _order_vault(i)[name]


@_query
def user_product_counters(i: Inputs) -> DataFrame:
    return order_vault.order_counters(order_vault.order_lines(_enriched(i)), "product")


@_query
def user_category_counters(i: Inputs) -> DataFrame:
    return order_vault.order_counters(order_vault.order_lines(_enriched(i)), "category")


# --- loads and write semantics --------------------------------------------------------

def _landed_csv(i: Inputs) -> DataFrame:
    """Group log as delimited lines; those of channel 13 have a broken user id."""
    where = work_dir(i.spark, "group_log")
    i.table("events").selectExpr(
        "concat_ws(',', cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20,"
        " if(regexp_extract(props, '([0-9]+)', 1) = '13', concat('u', user_id), cast(user_id as string)),"
        " user_id + event_id % 5, event_type, date_format(ts, 'yyyy-MM-dd HH:mm:ss')) as line"
    ).write.text(where)
    return files.load_csv(i.spark, where, schemas.GROUP_LOG)


@_query
def csv_load_good(i: Inputs) -> DataFrame:
    return files.good_rows(_landed_csv(i))


@_query
def csv_load_rejects(i: Inputs) -> DataFrame:
    return files.rejected_rows(_landed_csv(i)).select("rejected_line")


@_query
def incremental_files(i: Inputs) -> DataFrame:
    """Finished and queued transactions are loaded; then the queued files are touched and old files dropped in."""
    where, out = work_dir(i.spark, "transactions"), work_dir(i.spark, "stg")
    named = i.transactions.drop("load_dt", "load_src")
    for batch, statuses in enumerate((("done", "queued"), ("in_progress",))):
        for status in statuses:
            named.where(F.col("status") == status).write.option("header", True).csv(f"{where}/{status}")
        if batch:
            _set_time(i.spark, f"{where}/queued", "2100-01-01")
            _set_time(i.spark, f"{where}/in_progress", "2021-01-01")
        jobs.load_new_files(i.spark, where, out, "transactions", schemas.TRANSACTIONS, LOAD_DT, batch)
    return jobs.loaded_files(i.spark, out, "transactions")


def _set_time(spark: SparkSession, folder: str, day: str) -> None:
    """Give the files of a folder a modification time."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    millis = int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp() * 1000)
    for entry in store.listStatus(path):
        store.setTimes(entry.getPath(), millis, -1)


@_query
def load_with_lineage(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "currencies")
    i.currencies.drop("load_dt", "load_src").withColumn("remark", F.lit("x")).write.option("header", True).csv(where)
    found = files.list_files(i.spark, where, "currencies")
    return files.load_files(
        i.spark, where, f"{schemas.CURRENCIES}, remark string", files.files_to_load(found, None),
        F.lit(LOAD_DT).cast("timestamp_ntz"),
        columns=["date_update", "currency_code", "currency_code_with", "currency_with_div"]).drop("file_path", "modified")


@_query
def jdbc_snapshot_copy(i: Inputs) -> DataFrame:
    """The relation is a Parquet table here; a database needs only other options."""
    return relational.snapshot_copy(
        i.spark, "parquet", {"path": f"{i.sf_dir}/supplier.parquet"},
        ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], work_dir(i.spark, "snapshot"))


@_query
def outbox_incremental(i: Inputs) -> DataFrame:
    """Two runs: the first sees the older half of the outbox, the second all of it."""
    where, states = work_dir(i.spark, "outbox"), work_dir(i.spark, "state")
    rows, state = tables.empty_like(i.outbox), load_state.empty(i.spark)
    older = i.outbox.where(F.col("id") <= i.outbox.agg(F.expr("max(id) / 2")).scalar())
    for run, source in enumerate((older, i.outbox), start=1):
        fresh, moved = relational.outbox_increment(source, rows, state, run)
        tables.append_batch(fresh, where, run)
        tables.publish(moved, states)
        rows = i.spark.read.parquet(where).drop("batch_id")
        state = tables.latest(i.spark, states)
    return rows.select("id", "event_ts", "event_type")


@_query
def documents_incremental(i: Inputs) -> DataFrame:
    """Two runs over landed documents; the second brings the second version of each."""
    landing, target, states = (work_dir(i.spark, n) for n in ("landing", "documents", "state"))
    schema = "object_id string, object_value string, update_ts timestamp_ntz"
    docs, state = tables.empty_like(i.restaurant_documents), load_state.empty(i.spark)
    for run, until in enumerate(("2022-01-15", "2022-03-01"), start=1):
        arrived = i.restaurant_documents.where(F.col("update_ts") < F.lit(until).cast("timestamp_ntz"))
        arrived.write.json(f"{landing}/{run}")
        source = i.spark.read.schema(schema).json(f"{landing}/{run}")
        docs, moved = documents.documents_increment(source, docs, state, "restaurants", run)
        tables.publish(docs, target)
        tables.publish(moved, states)
        docs, state = tables.latest(i.spark, target), tables.latest(i.spark, states)
    items = with_document(docs, "object_value", schemas.RESTAURANT_DOC).select(
        "object_id", "update_ts", F.explode("doc.menu").alias("item"))
    return items.select(
        "object_id", "update_ts", document_id("item._id").alias("product_id"), "item.name",
        F.col("item.price").cast("double").alias("price"))


@_query
def api_snapshot_landing(i: Inputs) -> DataFrame:
    """The snapshot arrives twice; known contents are not loaded again."""
    where = work_dir(i.spark, "couriers")
    i.courier_content.write.text(f"{where}/landed/1")
    i.courier_content.write.text(f"{where}/landed/2")
    loaded = i.spark.createDataFrame([], documents.LANDED)
    landed = documents.read_landed(i.spark, f"{where}/landed/*")
    stamp = F.lit(LOAD_DT).cast("timestamp_ntz")
    tables.append_batch(documents.api_snapshot(landed, loaded, stamp), f"{where}/stg", 1)
    loaded = i.spark.read.parquet(f"{where}/stg").drop("batch_id")
    tables.append_batch(documents.api_snapshot(landed, loaded, stamp), f"{where}/stg", 2)
    parsed = couriers.parse_couriers(i.spark.read.parquet(f"{where}/stg"))
    count = i.spark.read.parquet(f"{where}/stg").agg(F.count(F.lit(1)).alias("rows")).scalar()
    return parsed.withColumn("loaded_rows", count)


@_query
def api_incremental_landing(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "deliveries")
    early = F.get_json_object("content", "$.delivery_ts") < "2028-01-01"
    tables.write_texts(i.delivery_content.where(early), f"{where}/landed/1")
    tables.write_texts(i.delivery_content, f"{where}/landed/2")
    stamp = F.lit(LOAD_DT).cast("timestamp_ntz")
    loaded = i.spark.createDataFrame([], documents.LANDED)
    state = load_state.empty(i.spark)
    for run in (1, 2):
        landed = documents.read_landed(i.spark, f"{where}/landed/{run}")
        fresh, moved = documents.api_increment(landed, loaded, state, run, stamp)
        tables.append_batch(fresh, f"{where}/stg", run)
        tables.publish(moved, f"{where}/state")
        loaded = i.spark.read.parquet(f"{where}/stg").drop("batch_id")
        state = tables.latest(i.spark, f"{where}/state")
    return loaded.select(
        F.get_json_object("content", "$.delivery_id").alias("delivery_id"),
        F.get_json_object("content", "$.delivery_ts").alias("delivery_ts"))


@_query
def daily_slices(i: Inputs) -> DataFrame:
    """The whole history day by day, then the last days again: no day is doubled."""
    where = work_dir(i.spark, "slices")
    source = i.table("events")
    for since in (None, "2024-01-25"):
        tables.replace_slices(
            relational.day_slices(source, "ts", "2024-01-30", since), where, "load_day")
    return i.spark.read.parquet(where).select("event_id", "ts", "load_src", "load_day")


@_query
def envelope_currencies(i: Inputs) -> DataFrame:
    return documents.currencies_from(
        documents.parse_envelopes(i.envelopes), F.lit(LOAD_DT).cast("timestamp_ntz"))


@_query
def envelope_transactions(i: Inputs) -> DataFrame:
    return documents.transactions_from(
        documents.parse_envelopes(i.envelopes), F.lit(LOAD_DT).cast("timestamp_ntz"))


@_query
def envelope_job_transactions(i: Inputs) -> DataFrame:
    """Two batches, the second sent again; cut copies of the messages and unknown types are rejected."""
    out = work_dir(i.spark, "envelopes")
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    cut = i.envelopes.select(F.expr("substring(value, 1, 30)").alias("value"))
    other = i.envelopes.select(F.regexp_replace("value", '"object_type":"', '"object_type":"OLD').alias("value"))
    for batch in (0, 1, 1):
        messages = i.envelopes.where(part == batch)
        jobs.envelope_job((messages.unionByName(cut).unionByName(other)) if batch else messages, out, LOAD_DT, batch)
    return i.spark.read.parquet(f"{out}/transactions").drop("batch_id")


@_query
def json_rejects(i: Inputs) -> DataFrame:
    """Order events and envelopes of which some are cut, some lack a field, some are of an unknown type."""
    order = i.table("orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("object_id"))
    kind = F.pmod(F.col("o_orderkey"), F.lit(7))
    named = order.withColumns({
        "object_type": F.when(kind == 3, F.lit("OTHER")).when(kind != 4, F.lit("TRANSACTION")),
        "payload": F.lit("{}")})
    text = F.to_json(F.struct("object_id", "object_type", "payload"))
    envelopes = named.select("o_orderkey", F.when(kind == 2, F.substring(text, 1, 20)).otherwise(text).alias("value"))
    event = F.to_json(F.struct(F.when(kind != 5, F.col("o_orderkey")).alias("object_id"), F.lit("order").alias("object_type")))
    events_ = order.select("o_orderkey", F.when(kind == 6, F.substring(event, 1, 10)).otherwise(event).alias("value"))
    return (
        documents.envelope_rejects(envelopes).withColumn("parser", F.lit("envelope"))
        .unionByName(order_vault.order_rejects(events_).withColumn("parser", F.lit("order")))
        .select("o_orderkey", "parser", "reason"))


def _first_orders(i: Inputs) -> DataFrame:
    return i.table("orders").select("o_custkey", F.col("o_orderdate").alias("first_order"))


@_query
def insert_if_absent_(i: Inputs) -> DataFrame:
    """Customers known before the split keep their marker; others come with their first order."""
    seen = _first_orders(i)
    target = seen.where(F.col("first_order") < SPLIT_DATE).groupBy("o_custkey").agg(
        F.max("first_order").alias("first_order")).withColumn("origin", F.lit("target"))
    return insert_if_absent(
        target, seen.withColumn("origin", F.lit("source")), ["o_custkey"], [F.col("first_order")])


def _order_states(i: Inputs) -> DataFrame:
    return order_vault.parse_order_events(i.order_events).select(
        "object_id", "sent_dttm", "payload.cost", F.col("payload.user.id").alias("user_id"))


@_query
def upsert_last_wins_(i: Inputs) -> DataFrame:
    states = _order_states(i)
    early = F.col("sent_dttm") < SPLIT_DATE
    order = ["sent_dttm", "cost", "user_id"]
    target = upsert_last_wins(tables.empty_like(states), states.where(early), ["object_id"], order)
    return upsert_last_wins(target, states.where(~early), ["object_id"], order)


@_query
def additive_upsert_(i: Inputs) -> DataFrame:
    counts = lambda df: df.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("order_cnt"))
    early = F.col("o_orderdate") < SPLIT_DATE
    return additive_upsert(
        counts(i.table("orders").where(early)), counts(i.table("orders").where(~early)),
        ["o_custkey", "o_orderstatus"], ["order_cnt"])


for _name in ("insert_if_absent", "upsert_last_wins", "additive_upsert"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_")


def _metrics(i: Inputs, load_dt: str, **options) -> DataFrame:
    return metrics.daily_metrics(i.transactions, i.currencies, load_dt, base_currency=0, **options)


@_query
def daily_metrics(i: Inputs) -> DataFrame:
    return _metrics(i, LOAD_DT)


@_query
def daily_metrics_with_base(i: Inputs) -> DataFrame:
    return _metrics(i, LOAD_DT, base_as_one=True)


@_query
def daily_metrics_upsert(i: Inputs) -> DataFrame:
    """Two loads that share their days: the second one's days are aggregated again, whole."""
    out = work_dir(i.spark, "upsert")
    late = F.pmod(F.xxhash64("operation_id"), F.lit(2)) == 1
    stamped = i.transactions.withColumn(
        "load_dt", F.when(late, F.lit("2024-01-02 12:00:00")).otherwise(F.lit("2024-01-01 12:00:00")).cast("timestamp_ntz"))
    for run, staged in enumerate((stamped.where(~late), stamped), start=1):
        jobs.metrics_job(staged, i.currencies, out, f"2024-01-0{run} 13:00:00", run, base_currency=0, mode="upsert")
    return tables.latest(i.spark, f"{out}/global_metrics").drop("load_dt", "load_src")


@_query
def merge_insert_only_(i: Inputs) -> DataFrame:
    """A full load, then an increment that also sees known days: those stay as they are."""
    first = metrics.daily_metrics(
        i.transactions.where(F.col("load_dt") < SPLIT_DATE), i.currencies, "2024-01-01", base_currency=0)
    return metrics.merge_metrics(first, _metrics(i, LOAD_DT, loaded_after="1997-06-01"))


_QUERIES["merge_insert_only"] = _QUERIES.pop("merge_insert_only_")


@_query
def load_state_(i: Inputs) -> DataFrame:
    """Three loads move the stored positions; the later run replaces the earlier."""
    dates = i.table("orders").select(F.to_date("o_orderdate").alias("day"))
    state = load_state.advance(
        load_state.empty(i.spark),
        load_state.progress(i.outbox, "stg", "outbox", "events", F.col("id"), 1),
        load_state.progress(dates.where(F.col("day") < SPLIT_DATE), "dwh", "stg", "metrics", F.col("day"), 1))
    state = load_state.advance(
        state, load_state.progress(dates, "dwh", "stg", "metrics", F.col("day"), 2),
        load_state.progress(tables.empty_like(dates), "stg", "outbox", "events", F.col("day"), 2))
    return state.select("layer", "source", "table", "value", "run_id")


_QUERIES["load_state"] = _QUERIES.pop("load_state_")


# --- streams ---------------------------------------------------------------------------

def _campaign_stream(i: Inputs, where: str) -> DataFrame:
    i.campaign_messages.write.parquet(f"{where}/in")
    return flow.message_stream(i.spark, "parquet", {}, f"{where}/in")


def _run(df: DataFrame, sink: flow.Sink, where: str) -> None:
    flow.start(df, sink, f"{where}/checkpoint").awaitTermination()


@_query
def static_subscribers(i: Inputs) -> DataFrame:
    return campaigns.static_subscribers(i.subscribers)


@_query
def campaign_active(i: Inputs) -> DataFrame:
    return campaigns.active_campaigns(campaigns.parse_campaigns(i.campaign_messages), CAMPAIGN_NOW).select(
        "restaurant_id", "adv_campaign_id", "adv_campaign_datetime_start", "adv_campaign_datetime_end")


@_query
def stream_parse(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "parse")
    parsed = campaigns.parse_campaigns(_campaign_stream(i, where)).drop("value", "org_timestamp")
    _run(parsed, flow.table_sink(f"{where}/out"), where)
    return i.spark.read.parquet(f"{where}/out").drop("batch_id")


@_query
def stream_dedup(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "dedup")
    offers = campaigns.first_offers(campaigns.parse_campaigns(_campaign_stream(i, where)))
    _run(offers.select(*campaigns.CAMPAIGN_KEY), flow.table_sink(f"{where}/out"), where)
    return i.spark.read.parquet(f"{where}/out").drop("batch_id")


def _push(i: Inputs, where: str) -> DataFrame:
    return campaigns.campaign_push(_campaign_stream(i, where), i.subscribers, CAMPAIGN_NOW)


@_query
def campaign_push(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "push")
    _run(_push(i, where), flow.table_sink(f"{where}/out"), where)
    return i.spark.read.parquet(f"{where}/out").drop("batch_id")


@_query
def campaign_push_by_buckets(i: Inputs) -> DataFrame:
    """The whole job: audience in buckets by restaurant, joined inside each micro-batch; the second start finds nothing new."""
    out = work_dir(i.spark, "campaigns")
    stream = _campaign_stream(i, out)
    for _ in range(2):
        jobs.campaign_job(
            stream, i.subscribers, out, flow.table_sink(f"{out}/sent"), now=CAMPAIGN_NOW, buckets=16).awaitTermination()
    return i.spark.read.parquet(f"{out}/sent").drop("batch_id")


@_query
def stream_fanout(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "fanout")
    sinks = flow.fan_out(
        flow.json_sink(f"{where}/topic", campaigns.OUT_COLUMNS),
        lambda df, batch_id: tables.append_batch(flow.feedback_rows(df), f"{where}/feedback", batch_id))
    _run(_push(i, where), sinks, where)
    key = ["client_id", "restaurant_id", "adv_campaign_id"]
    topic = i.spark.read.text(f"{where}/topic").select(
        F.lit("topic").alias("sink"), F.from_json("value", "client_id string, restaurant_id string, adv_campaign_id string").alias("m"))
    stored = i.spark.read.parquet(f"{where}/feedback")
    return topic.select("sink", "m.*", F.lit("").alias("feedback")).unionByName(
        stored.select(F.lit("feedback").alias("sink"), *key, "feedback"))


@_query
def sink_json_value(i: Inputs) -> DataFrame:
    return flow.messages(campaigns.active_campaigns(
        campaigns.parse_campaigns(i.campaign_messages), CAMPAIGN_NOW),
        ["restaurant_id", "adv_campaign_id", "adv_campaign_datetime_start"])


@_query
def sink_jdbc_feedback(i: Inputs) -> DataFrame:
    """The relation is a Parquet table here; a database needs only other options."""
    where = work_dir(i.spark, "feedback")
    active = campaigns.active_campaigns(campaigns.parse_campaigns(i.campaign_messages), CAMPAIGN_NOW).select(
        "restaurant_id", "adv_campaign_id", "trigger_datetime_created")
    flow.feedback_sink("parquet", {"path": where})(active, 0)
    return i.spark.read.parquet(where)


def _counter_texts(i: Inputs, files: int | None = None) -> DataFrame:
    """Messages for the counters; dealt into ``files`` as narrow lines, before hashes and text make them wide."""
    lines = order_vault.order_lines(_enriched(i))
    return order_vault.to_messages(order_vault.counter_messages(lines.repartition(files) if files else lines))


@_query
def stream_user_product_counters(i: Inputs) -> DataFrame:
    where = work_dir(i.spark, "counters")
    tables.write_texts(_counter_texts(i, 6 * PARTS), f"{where}/in")
    orders.counter_query(i.spark, f"{where}/in", where, files_per_batch=2 * PARTS).awaitTermination()
    return orders.current_counters(i.spark, where)


@_query
def stream_restart_no_double(i: Inputs) -> DataFrame:
    """The query stops after a part of the messages and goes on from its checkpoint; some are sent twice."""
    where = work_dir(i.spark, "restart")
    texts = _counter_texts(i)
    tables.write_texts(texts.where(F.pmod(F.hash("value"), F.lit(2)) == 0), f"{where}/in/1")
    orders.counter_query(i.spark, f"{where}/in", where, by="category").awaitTermination()
    tables.write_texts(texts, f"{where}/in/2")
    orders.counter_query(i.spark, f"{where}/in", where, by="category").awaitTermination()
    return orders.current_counters(i.spark, where, "category")


@_query
def order_chain_counters(i: Inputs) -> DataFrame:
    """Staging, vault and counter queries one after another, each reading the folder of the one before."""
    where = work_dir(i.spark, "chain")
    tables.write_texts(i.dealt_order_events(4 * PARTS), f"{where}/in")
    orders.staging_query(
        i.spark, f"{where}/in", f"{where}/stg", i.user_entries, i.restaurant_entries, 2 * PARTS).awaitTermination()
    orders.vault_query(
        i.spark, f"{where}/stg/messages", f"{where}/dds", LOAD_DT, ["h_order", "l_order_product"], 30
    ).awaitTermination()
    orders.counter_query(i.spark, f"{where}/dds/messages", where).awaitTermination()
    return orders.current_counters(i.spark, where)
