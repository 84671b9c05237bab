"""Sources, sinks and streams on small files."""

import json
import os
import time
from datetime import datetime

from helpers import values
from pyspark.sql import functions as F

from martloom import schemas
from martloom.operators import state as load_state
from martloom.plans import order_vault
from martloom.session import CLEANUP, stored, work_dir
from martloom.sources import buckets, documents, events, files, relational, tables
from martloom.streaming import campaigns, flow, orders

from test_plans import order_text

NOW = 1_700_000_000


# --- tables --------------------------------------------------------------------------

def test_publish_skips_incomplete_versions(spark, tmp_path):
    where = str(tmp_path / "t")
    assert tables.latest(spark, where) is None
    assert tables.publish(spark.range(1), where) == 1
    assert tables.publish(spark.range(2), where, sort_by=["id"]) == 2
    assert tables.latest(spark, where).count() == 2
    os.makedirs(f"{where}/version=3")               # a run that died half-way
    assert tables.latest(spark, where).count() == 2
    assert tables.publish(spark.range(3), where) == 3
    assert tables.latest(spark, where).count() == 3


def test_repeated_batch_changes_nothing(spark, tmp_path):
    where = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    buckets.append_new(df, where, ["k"], 0)
    buckets.append_new(df.union(spark.createDataFrame([("c", 4)], "k string, v int")), where, ["k"], 1)
    buckets.append_new(df.union(spark.createDataFrame([("c", 4)], "k string, v int")), where, ["k"], 1)
    assert values(spark.read.parquet(where), "k") == [("a",), ("b",), ("c",)]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    left = tables.save_bucketed(spark.range(50).withColumnRenamed("id", "k"), "bucketed_left", str(tmp_path / "l"), "k", 4)
    right = tables.save_bucketed(spark.range(50).selectExpr("id as k", "id as v"), "bucketed_right", str(tmp_path / "r"), "k", 4)
    joined = left.hint("merge").join(right, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


def test_stored_uses_the_shared_folder(spark):
    df = stored(spark.range(5), "x")
    assert df.count() == 5
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffle_files_go_when_a_write_has_ended(spark, tmp_path):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    before = shuffles()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    stored(rows, "counts")
    tables.append_batch(rows, f"{tmp_path}/batches", 0)
    tables.publish(rows, f"{tmp_path}/versions")
    tables.write_texts(rows.select(F.col("k").cast("string")), f"{tmp_path}/texts")
    buckets.BucketTable(spark, f"{tmp_path}/buckets", ["k"], rows.schema, 2).append(rows, 0)
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(CLEANUP) == "false"


def test_slices_replace_only_their_days(spark, tmp_path):
    where = str(tmp_path / "s")
    source = spark.sql("select id, timestampadd(HOUR, cast(id * 12 as int), timestamp_ntz'2024-01-01 00:00:00') as ts from range(6)")
    tables.replace_slices(relational.day_slices(source, "ts", "2024-01-03"), where, "load_day")
    assert spark.read.parquet(where).count() == 4
    tables.replace_slices(relational.day_slices(source, "ts", "2024-01-04", "2024-01-02"), where, "load_day")
    assert values(spark.read.parquet(where), "id") == [(n,) for n in range(6)]


# --- files ------------------------------------------------------------------------------

def test_csv_good_and_rejected(spark, tmp_path):
    (tmp_path / "log.csv").write_text("1,2,3,add,2024-01-01 00:00:00\nx,2,3,add,2024-01-01 00:00:00\n1,2,,leave,2024-01-02 00:00:00\n")
    loaded = files.load_csv(spark, str(tmp_path), schemas.GROUP_LOG)
    assert values(files.good_rows(loaded), "group_id", "user_id_from", "event") == [(1, 3, "add"), (1, None, "leave")]
    assert values(files.rejected_rows(loaded), "rejected_line") == [("x,2,3,add,2024-01-01 00:00:00",)]


def test_touched_and_new_files_are_loaded(spark, tmp_path):
    for name in ("currencies_a.csv", "currencies_b.csv", "transactions.csv"):
        (tmp_path / name).write_text("date_update,currency_code,currency_code_with,currency_with_div\n2024-01-01 00:00:00,1,2,1.5\n")
        os.utime(tmp_path / name, (NOW, NOW))
    found = files.list_files(spark, str(tmp_path), "currencies")
    assert files.files_to_load(found, None).count() == 2
    manifest = files.updated_manifest(found, None).persist()
    assert manifest.count() == 2
    assert files.files_to_load(files.list_files(spark, str(tmp_path), "currencies"), manifest).count() == 0
    os.utime(tmp_path / "currencies_b.csv", (NOW + 60, NOW + 60))
    (tmp_path / "currencies_c.csv").write_text("date_update,currency_code,currency_code_with,currency_with_div\n2024-01-02 00:00:00,3,2,1.7\n")
    again = files.files_to_load(files.list_files(spark, str(tmp_path), "currencies"), manifest)
    assert sorted(r.file_path[-5:] for r in again.collect()) == ["b.csv", "c.csv"]
    rows = files.load_files(spark, str(tmp_path), schemas.CURRENCIES, again, F.lit("2024-02-01").cast("timestamp_ntz"))
    assert values(rows, "currency_code", "load_src") == [(1, "S3"), (3, "S3")]


# --- relational and documents -----------------------------------------------------------------

def test_jdbc_options():
    assert relational.jdbc_options("jdbc:x:y", "t", user="u", password="p") == {
        "url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000", "user": "u", "password": "p"}
    parallel = relational.jdbc_options("jdbc:x:y", "t", partition_column="id", bounds=(0, 100), partitions=4)
    assert (parallel["numPartitions"], parallel["lowerBound"], parallel["upperBound"]) == ("4", "0", "100")


def test_outbox_filter_is_pushed_down(spark, tmp_path):
    where = str(tmp_path / "outbox")
    spark.range(10).selectExpr(
        "id", "timestamp_ntz'2024-01-01 00:00:00' as event_ts", "'t' as event_type", "'{}' as event_value").write.parquet(where)
    source = relational.read_relation(spark, "parquet", {"path": where})
    state = load_state.advance(load_state.empty(spark), load_state.progress(
        source.where("id <= 6"), "stg", "outbox", "events", F.col("id"), 1))
    fresh, moved = relational.outbox_increment(source, tables.empty_like(source), state, 2)
    assert "GreaterThan(id,6)" in fresh._jdf.queryExecution().executedPlan().toString()
    assert values(fresh, "id") == [(7,), (8,), (9,)]
    assert load_state.read(moved, "stg", "outbox", "events") == "9"


def test_first_load_takes_old_documents(spark):
    rows = [("a", "1", 1), ("b", "1", 2), ("c", "1", 2), ("d", "1", 3), ("a", "2", 4)]
    source = spark.createDataFrame(
        [(k, v, datetime(1999, 1, d)) for k, v, d in rows], "object_id string, object_value string, update_ts timestamp_ntz")
    target, state, sizes = tables.empty_like(source), load_state.empty(spark), []
    for run, day in enumerate((2, 3, 4), start=1):
        arrived = source.where(F.day("update_ts") <= day)
        target, state = documents.documents_increment(arrived, target, state, "orders", run)
        target, state = stored(target, "docs"), stored(state, "state")
        sizes.append(target.count())
    assert sizes == [3, 4, 4]
    assert values(target, "object_id", "object_value") == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "1")]


def test_envelopes(spark):
    texts = [
        {"object_id": "1", "object_type": "TRANSACTION", "sent_dttm": "2022-10-01T00:24:02", "payload": {
            "operation_id": "1", "account_number_from": 5, "account_number_to": 6, "currency_code": 420, "country": "usa",
            "status": "done", "transaction_type": "sbp_incoming", "amount": 50000, "transaction_dt": "2022-10-01 00:24:02"}},
        {"object_id": "2", "object_type": "CURRENCY", "sent_dttm": "2022-10-02T00:00:00", "payload": {
            "date_update": "2022-10-02 00:00:00", "currency_code": 410, "currency_code_with": 460, "currency_with_div": 0.95}}]
    feed = spark.createDataFrame([(json.dumps(t),) for t in texts] + [("{",)], "value string")
    parsed = documents.parse_envelopes(feed)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    t, c = documents.transactions_from(parsed, stamp).collect(), documents.currencies_from(parsed, stamp).collect()
    assert [(r.operation_id, r.amount, r.transaction_dt, r.load_src) for r in t] == [
        ("1", 50000, datetime(2022, 10, 1, 0, 24, 2), "Kafka-transaction")]
    assert [(r.currency_code, float(r.currency_with_div)) for r in c] == [(410, 0.95)]


def test_envelope_job_rejects(spark, tmp_path):
    from martloom.plans import jobs
    out = str(tmp_path)
    good = {"operation_id": "1", "amount": 5, "transaction_dt": "2022-10-01 00:24:02"}
    rate = {"date_update": "2022-10-02 00:00:00", "currency_code": 410, "currency_code_with": 460, "currency_with_div": 0.95}
    texts = [json.dumps({"object_id": "x", "object_type": kind, "payload": payload}) for kind, payload in [
        ("TRANSACTION", good), ("CURRENCY", rate), ("OTHER", good), (None, good), ("TRANSACTION", None),
        ("TRANSACTION", {**good, "operation_id": None}), ("CURRENCY", {**rate, "date_update": "soon"})]] + ["{"]
    feed = spark.createDataFrame([(t,) for t in texts], "value string")
    for _ in range(2):
        jobs.envelope_job(feed, out, "2024-01-01", 7)
    jobs.envelope_job(feed.limit(0), out, "2024-01-01", 8)
    assert values(spark.read.parquet(f"{out}/transactions"), "operation_id", "amount", "load_src") == [("1", 5, "Kafka-transaction")]
    assert values(spark.read.parquet(f"{out}/currencies"), "currency_code", "load_src") == [(410, "Kafka-currency")]
    assert values(spark.read.parquet(f"{out}/envelopes_rej"), "reason") == [(r,) for r in [
        "broken", "missing object_type", "missing payload", "payload broken", "payload missing operation_id", "unknown type"]]


def test_scan_merges_schemas_and_prunes_types(spark, tmp_path):
    where = str(tmp_path / "log")
    one = "select 1L as event_id, named_struct('message_id', 1L) as event, 'message' as event_type"
    spark.sql(one).write.partitionBy("event_type").parquet(where)
    spark.sql(f"select *, 'new' as extra from ({one}) union all select 2L, named_struct('message_id', null), 'message', 'x'"
              " union all select 3L, named_struct('message_id', 3L), 'reaction', 'x'").write.mode(
        "append").partitionBy("event_type").parquet(where)
    got = events.scan_events(spark, where, "message")
    assert "extra" in got.columns and got.count() == 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan


# --- streams -------------------------------------------------------------------------------------

def campaign(restaurant, key, start=-10, end=10, text="t"):
    return json.dumps({
        "restaurant_id": restaurant, "adv_campaign_id": key, "adv_campaign_content": text, "adv_campaign_owner": "o",
        "adv_campaign_owner_contact": "c", "adv_campaign_datetime_start": NOW + start,
        "adv_campaign_datetime_end": NOW + end, "datetime_created": NOW - 100})


def put(spark, where, *texts):
    spark.createDataFrame([(t, datetime(2023, 11, 14, 22)) for t in texts], "value string, timestamp timestamp").coalesce(
        1).write.mode("append").parquet(where)


def test_campaign_push_over_restarts(spark, tmp_path):
    where = str(tmp_path)
    subscribers = spark.createDataFrame(
        [(1, "u1", "r1"), (2, "u1", "r1"), (3, "u2", "r1"), (4, "u3", "r2"), (5, None, "r1")],
        "id long, client_id string, restaurant_id string")

    def run():
        stream = flow.message_stream(spark, "parquet", {}, f"{where}/in")
        sinks = flow.fan_out(
            flow.json_sink(f"{where}/topic", campaigns.OUT_COLUMNS), flow.table_sink(f"{where}/out"))
        flow.start(campaigns.campaign_push(stream, subscribers, NOW), sinks, f"{where}/cp").awaitTermination()

    put(spark, f"{where}/in", campaign("r1", "expired", -20, -10), campaign("r1", "future", 10, 20),
        campaign("r1", "edge", 0, 10), campaign("r3", "nobody"), "{broken", campaign("r1", "late", -20, -10))
    run()
    put(spark, f"{where}/in", campaign("r1", "a"), campaign("r1", "a"), campaign("r2", "a"), campaign("r1", "late"))
    run()
    put(spark, f"{where}/in", campaign("r1", "a"))
    run()
    want = [("u1", "r1", "a"), ("u1", "r1", "late"), ("u2", "r1", "a"), ("u2", "r1", "late"), ("u3", "r2", "a")]
    assert values(spark.read.parquet(f"{where}/out"), "client_id", "restaurant_id", "adv_campaign_id") == want
    sent = [json.loads(r.value) for r in spark.read.text(f"{where}/topic").collect()]
    assert len(sent) == len(want) and set(sent[0]) == set(campaigns.OUT_COLUMNS)


def test_now_is_taken_per_micro_batch(spark):
    df = spark.sql("select 1L as adv_campaign_datetime_start, 9999999999L as adv_campaign_datetime_end")
    assert campaigns.active_campaigns(df).count() == 1


def test_order_chain_equals_batch(spark, tmp_path):
    where = str(tmp_path)
    users = spark.createDataFrame([("u1", "Ann", None), ("u2", "Bob", "bob")], "_id string, name string, login string")
    places = spark.createDataFrame(
        [("r1", "Cafe", [("a", "soup"), ("b", "cake")])], "_id string, name string, menu array<struct<_id: string, category: string>>")

    def put_orders(name, *texts):
        os.makedirs(f"{where}/in", exist_ok=True)
        with open(f"{where}/in/{name}.txt", "w") as out:
            out.write("\n".join(texts) + "\n")

    def run():
        orders.staging_query(spark, f"{where}/in", f"{where}/stg", users, places, 1).awaitTermination()
        orders.vault_query(spark, f"{where}/stg/messages", f"{where}/dds", "2024-02-01", ["h_order", "l_order_product"], 1).awaitTermination()
        for by in ("product", "category"):
            orders.counter_query(spark, f"{where}/dds/messages", f"{where}/cdm", by, 1).awaitTermination()

    first = [order_text(1, "ab"), order_text(2, "a", "u2"), "{broken"]
    second = [order_text(1, "ab", sent="2024-01-02 00:00:00"), order_text(3, "ax")]
    put_orders("1", *first)
    run()
    put_orders("2", *second)
    run()
    run()
    messages = spark.createDataFrame([(t,) for t in first + second], "value string")
    lines = order_vault.order_lines(order_vault.enrich_orders(order_vault.parse_order_events(messages), users, places))
    for by in ("product", "category"):
        columns = ["user_id", f"{by}_id", f"{by}_name", "order_cnt"]
        assert values(orders.current_counters(spark, f"{where}/cdm", by), *columns) == values(
            order_vault.order_counters(lines, by), *columns)
    assert orders.vault_table(spark, f"{where}/dds", "h_order").count() == 3
    assert orders.vault_table(spark, f"{where}/dds", "l_order_product").count() == 5
    assert values(spark.read.parquet(f"{where}/stg/rejects"), "value", "reason") == [("{broken", "broken")]
    staged = orders.staged_orders(spark, f"{where}/stg")
    assert {r.object_id: r.sent_dttm.day for r in staged.collect()} == {1: 2, 2: 1, 3: 1}


def counter_text(user, order, name="soup", product="a"):
    return json.dumps({"user_id": user, "product_id": product, "product_name": name, "category_id": "c",
                       "category_name": "food", "order_id": order})


def test_counters_hold_no_state_and_survive_repeats(spark, tmp_path):
    where = str(tmp_path)

    def run(*texts):
        put(spark, f"{where}/in", *texts)
        query = orders.counter_query(spark, f"{where}/in", where, fmt="parquet")
        query.awaitTermination()
        assert not query.lastProgress["stateOperators"]

    run(counter_text("u1", "1"), counter_text("u1", "1", "broth"), counter_text("u2", "1"), "{broken",
        json.dumps({"user_id": "u1", "product_id": "a"}))
    run(counter_text("u1", "1", "later"), counter_text("u1", "2", "soup"), counter_text("u1", None))
    columns = ["user_id", "product_id", "product_name", "order_cnt"]
    want = [("u1", "a", "broth", 2), ("u2", "a", "soup", 1)]
    assert values(orders.current_counters(spark, where), *columns) == want
    # A batch that ran but was not committed runs again.
    for folder, name in (("commits", "1"), ("commits", ".1.crc")):
        os.remove(f"{where}/checkpoint_product/{folder}/{name}")
    run()
    assert values(orders.current_counters(spark, where), *columns) == want
    assert sorted(r.reason for r in spark.read.parquet(f"{where}/product_rejects").collect()) == [
        "broken", "missing order_id", "missing order_id"]


def test_order_chain_through_a_broker_sink(spark, tmp_path):
    """The topic is a table of (key, value) here; a broker needs only other options."""
    where = str(tmp_path)
    users = spark.createDataFrame([("u1", "Ann", None)], "_id string, name string, login string")
    places = spark.createDataFrame(
        [("r1", "Cafe", [("a", "soup")])], "_id string, name string, menu array<struct<_id: string, category: string>>")
    send = flow.broker_sink("parquet", {"path": f"{where}/topic"}, key=["object_id"])
    for n in (1, 2):
        put(spark, f"{where}/in", order_text(n, "a"))
        orders.staging_query(spark, f"{where}/in", f"{where}/stg", users, places, fmt="parquet", send=send).awaitTermination()
    topic = spark.read.parquet(f"{where}/topic")
    assert values(topic, "key") == [('{"object_id":1}',), ('{"object_id":2}',)]
    orders.vault_query(spark, f"{where}/topic", f"{where}/dds", "2024-02-01", ["h_order"], fmt="parquet").awaitTermination()
    assert orders.vault_table(spark, f"{where}/dds", "h_order").count() == 2


def test_feedback_sink(spark, tmp_path):
    where = str(tmp_path / "feedback")
    flow.feedback_sink("parquet", {"path": where})(spark.range(2), 0)
    flow.feedback_sink("parquet", {"path": where})(spark.range(2), 1)
    assert values(spark.read.parquet(where)) == [(0, ""), (0, ""), (1, ""), (1, "")]
