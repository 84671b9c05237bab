"""Whole jobs on the smallest data: repeated runs change nothing, later runs add."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import values
from pyspark.sql import functions as F

from martloom import schemas
from martloom.bindings import AS_OF, CAMPAIGN_NOW, LOAD_DT, Inputs
from martloom.plans import geo_marts, jobs, messenger, metrics, order_vault, settlement
from martloom.session import stored, work_folders_removed
from martloom.sources import events, tables
from martloom.sources.buckets import BucketTable
from martloom.streaming import flow

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_DIR)


def test_settlement_job(spark, inputs, tmp_path):
    out = str(tmp_path)
    inputs.order_documents.write.json(f"{out}/landing")
    for run in (1, 2):
        staged = jobs.load_documents(spark, f"{out}/landing", f"{out}/stg", "orders", run)
        jobs.settlement_job(
            inputs.user_documents, inputs.restaurant_documents, staged, inputs.outbox, f"{out}/dds", AS_OF)
    assert staged.count() == inputs.order_documents.count()
    fact = spark.read.parquet(f"{out}/dds/fct_product_sales")
    products = jobs.product_tables(spark, f"{out}/dds", settlement.menu_items(inputs.restaurant_documents))[1].read()
    assert products.select("id").distinct().count() == products.count()
    assert fact.join(products.select(F.col("id").alias("product_id")), "product_id").count() == fact.count()
    report = spark.read.parquet(f"{out}/dds/dm_settlement_report")
    assert report.count() > 0 and report.agg(F.max("settlement_date").cast("string")).first()[0] < AS_OF


def test_courier_job(spark, inputs, tmp_path):
    for _ in range(2):
        jobs.courier_job(inputs.courier_content, inputs.delivery_content, str(tmp_path))
    fact = spark.read.parquet(f"{tmp_path}/fct_api_sales")
    ledger = spark.read.parquet(f"{tmp_path}/dm_courier_ledger")
    assert ledger.agg(F.sum("orders_count")).first()[0] == fact.count() == 6000


def test_messenger_job_rerun(spark, inputs, tmp_path):
    out = str(tmp_path)
    for name in ("users", "groups", "dialogs", "group_log"):
        frame = getattr(inputs, name)
        if name == "dialogs":
            frame = frame.withColumn("message", F.lit("text"))
        frame.write.csv(f"{out}/in/{name}.csv")
    stage = jobs.load_messenger_csv(spark, f"{out}/in", f"{out}/stg")
    assert stage["dialogs"].count() == inputs.dialogs.count()
    assert spark.read.parquet(f"{out}/stg/users_rej").count() == 0
    for batch in (0, 1):
        jobs.messenger_job(stage, f"{out}/dwh", LOAD_DT, batch)
        vault = messenger.messenger_vault(inputs.users, inputs.groups, inputs.dialogs, inputs.group_log, LOAD_DT)
        for name in ("hub_users", "link_user_message", "sat_auth_history"):
            assert spark.read.parquet(f"{out}/dwh/{name}").count() == vault[name].count()
    assert values(spark.read.parquet(f"{out}/dwh/group_conversion")) == values(messenger.group_conversion(vault))


def test_geo_job_on_a_log_without_event_ids(spark, inputs, tmp_path):
    out = str(tmp_path)
    tables.overwrite(inputs.geo_events.drop("event_id"), f"{out}/log", ["date", "event_type"])
    inputs.geo_raw.write.parquet(f"{out}/geo")
    jobs.geo_job(spark, f"{out}/log", f"{out}/geo", out, LOAD_DT)
    zones = events.geo_dimension(inputs.geo_raw)
    assert values(spark.read.parquet(f"{out}/user_geo_stats")) == values(
        geo_marts.user_geo_stats(inputs.geo_events, zones))
    assert values(spark.read.parquet(f"{out}/zone_stats")) == values(geo_marts.zone_stats(inputs.geo_events, zones))


def test_order_job_batches(spark, inputs, tmp_path):
    out = str(tmp_path)
    half = F.pmod(F.hash("value"), F.lit(2)) == 0
    broken = spark.createDataFrame([("{\"object_id\": 1, ",)], "value string")
    batches = (inputs.order_events.where(half), inputs.order_events, inputs.order_events.where(half).unionByName(broken))
    for batch, messages in enumerate(batches):
        jobs.order_job(messages, inputs.user_entries, inputs.restaurant_entries, out, LOAD_DT, batch)
    raw = order_vault.parse_order_events(inputs.order_events)
    lines = order_vault.order_lines(order_vault.enrich_orders(raw, inputs.user_entries, inputs.restaurant_entries))
    for name, df in order_vault.order_vault(lines, LOAD_DT).items():
        if name in ("h_order", "l_order_product", "s_user_names"):
            assert values(spark.read.parquet(f"{out}/{name}"), *df.columns) == values(df)
    jobs.order_job(batches[2], inputs.user_entries, inputs.restaurant_entries, out, LOAD_DT, 2)  # sent again
    for by in ("product", "category"):
        assert values(spark.read.parquet(f"{out}/user_{by}_counters")) == values(order_vault.order_counters(lines, by))
    assert values(spark.read.parquet(f"{out}/orders_rej"), "value", "reason") == [("{\"object_id\": 1, ", "broken")]


def test_metrics_job_over_files(spark, inputs, tmp_path):
    out = str(tmp_path)
    plain = inputs.transactions.drop("load_dt", "load_src")
    early = F.col("transaction_dt") < "1998-01-01"
    rates = inputs.currencies

    def run(n):
        jobs.load_new_files(
            spark, f"{out}/s3", f"{out}/stg", "transactions", schemas.TRANSACTIONS, f"2024-01-0{n} 12:00:00", n)
        staged = jobs.loaded_files(spark, f"{out}/stg", "transactions")
        jobs.metrics_job(staged, rates, f"{out}/dwh", f"2024-01-0{n} 12:00:00", n, base_currency=0)
        return staged.count(), tables.latest(spark, f"{out}/dwh/global_metrics")

    plain.where(early).write.option("header", True).csv(f"{out}/s3/transactions_1")
    count, first = run(1)
    assert count == plain.where(early).count()
    days = first.count()
    plain.where(~early).write.option("header", True).csv(f"{out}/s3/transactions_2")
    count, second = run(2)
    assert count == plain.count() and second.count() > days
    count, third = run(3)
    assert count == plain.count() and values(third) == values(second)
    spark.createDataFrame([("header",), ("x,not a number,1,2",)], "value string").coalesce(1).write.text(f"{out}/s3/transactions_3")
    run(4)
    assert [r.rejected_line for r in spark.read.parquet(f"{out}/stg/transactions_rej").collect()] == ["x,not a number,1,2"]


def test_outbox_job_after_a_stop(spark, inputs, tmp_path):
    """A run that wrote its rows but not its state is repeated without doubling any."""
    out = str(tmp_path)
    older = inputs.outbox.where("id < 1000")
    jobs.outbox_job(older, out, 1)
    tables.append_batch(inputs.outbox.where("id >= 1000 and id < 1500"), f"{out}/events", 2)
    jobs.outbox_job(inputs.outbox, out, 3)
    jobs.outbox_job(inputs.outbox, out, 4)
    rows = spark.read.parquet(f"{out}/events")
    assert rows.count() == rows.select("id").distinct().count() == inputs.outbox.select("id").distinct().count()


def test_api_job_repeats(spark, inputs, tmp_path):
    out, wanted = str(tmp_path), inputs.delivery_content.distinct().count()
    early = F.get_json_object("content", "$.delivery_ts") < "2027-01-01"
    for run, landed in enumerate((inputs.delivery_content.where(early), inputs.delivery_content, inputs.delivery_content), 1):
        jobs.api_job(landed, out, run, LOAD_DT)
    assert spark.read.parquet(f"{out}/payloads").count() == wanted
    for run in (1, 2):
        jobs.api_job(inputs.courier_content, f"{out}/couriers", run, LOAD_DT, snapshot=True)
    assert spark.read.parquet(f"{out}/couriers/payloads").count() == inputs.courier_content.distinct().count()


def test_day_slices_job_repeats(spark, inputs, tmp_path):
    source = inputs.table("events")
    for since in (None, "2024-01-10"):
        jobs.day_slices_job(source, "ts", str(tmp_path), "2024-01-20", since)
    assert spark.read.parquet(str(tmp_path)).count() == source.where("ts < '2024-01-20'").count()


def test_metrics_upsert_keeps_whole_days(spark, tmp_path):
    def rows(*amounts):
        return spark.createDataFrame([(f"{n}", n, 430, "done", n, f"2024-01-0{d} 10:00:00") for n, d in amounts],
            "operation_id string, account_number_from long, currency_code int, status string, amount long, at string").selectExpr(
            "*", "timestamp_ntz'2024-01-01 05:00:00' as transaction_dt", "cast(at as timestamp_ntz) as load_dt").drop("at")
    rates = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' as date_update, 430 as currency_code, 420 as currency_code_with,"
        " cast(1 as decimal(5,3)) as currency_with_div, timestamp_ntz'2024-01-01 00:00:00' as load_dt")
    for run, staged in ((1, rows((100, 1))), (2, rows((100, 1), (50, 3)))):
        jobs.metrics_job(staged, rates, str(tmp_path), f"2024-01-0{run + 3} 00:00:00", run, mode="upsert")
    got = tables.latest(spark, f"{tmp_path}/global_metrics").collect()
    assert [(int(r.amount_total), r.cnt_transactions) for r in got] == [(150, 2)]


def test_metrics_state_needs_new_transactions_only(spark, inputs, tmp_path):
    """Late parts of the same days arrive alone; the mart equals the one made from everything, also after repeats."""
    part = F.pmod(F.xxhash64("operation_id"), F.lit(3))
    staged = inputs.transactions.withColumn("part", part).withColumn(
        "load_dt", F.expr("timestamp_ntz'2024-01-01 08:00:00' + make_interval(0, 0, 0, 0, part)"))
    parts = [staged.where(F.col("part") == n) for n in range(3)]

    def mart(out):
        columns = ["date_update", "currency_from", "amount_total", "cnt_transactions", "cnt_accounts_make_transactions"]
        return sorted(map(tuple, tables.latest(spark, f"{out}/global_metrics").select(*columns).collect()))

    for run, rows in enumerate(parts, start=1):
        jobs.metrics_job(rows, inputs.currencies, f"{tmp_path}/a", f"2024-01-0{run} 00:00:00", run, 0, "upsert")
    whole = metrics.daily_metrics(staged, inputs.currencies, "2024-01-03", 0)
    want = sorted(map(tuple, whole.select(
        "date_update", "currency_from", "amount_total", "cnt_transactions", "cnt_accounts_make_transactions").collect()))
    assert mart(f"{tmp_path}/a") == want and len(want) > 0
    # A run that kept its part but not its load state is repeated, under another number.
    kept = BucketTable(spark, f"{tmp_path}/b/global_metrics_state", metrics.KEYS, metrics.STATE)
    kept.append(metrics.day_state(parts[0]), 0)
    for run, rows in enumerate([parts[0], staged, staged, parts[0].limit(0)], start=7):
        jobs.metrics_job(rows, inputs.currencies, f"{tmp_path}/b", f"2024-01-{run:02d} 00:00:00", run, 0, "upsert")
    assert mart(f"{tmp_path}/b") == want


def test_metrics_state_of_scattered_accounts_is_small(spark):
    """Accounts far apart: the state grows with the transactions, not with the ranges their numbers fall into."""
    rows = spark.range(200).selectExpr(
        "cast(id as string) as operation_id", "id * 40000 + 1 as account_number_from", "1 as currency_code", "'done' as status",
        "id as amount", "timestamp_ntz'2024-01-01 00:00:00' as transaction_dt")
    state = metrics.day_state(rows.union(rows))
    assert state.count() == 200 and "binary" not in dict(state.dtypes).values()
    day = metrics.merged_days(state.union(state)).first()
    assert (day.cnt_transactions, day.cnt_accounts_make_transactions, day.amount_local) == (800, 200, 4 * 199 * 100)


def test_campaign_job(spark, inputs, tmp_path):
    out = str(tmp_path)
    inputs.campaign_messages.write.parquet(f"{out}/in")
    stream = flow.message_stream(spark, "parquet", {}, f"{out}/in")
    for _ in range(2):  # the second start finds nothing new
        jobs.campaign_job(
            stream, inputs.subscribers, out, flow.table_sink(f"{out}/sent"), flow.json_sink(f"{out}/topic"),
            now=CAMPAIGN_NOW).awaitTermination()
    sent = spark.read.parquet(f"{out}/sent")
    assert sent.count() == sent.select("client_id", "restaurant_id", "adv_campaign_id").distinct().count() > 0
    assert spark.read.text(f"{out}/topic").count() == sent.count()


def test_campaign_batch_opens_only_its_buckets(spark, tmp_path):
    """A restaurant with a third of all subscribers; messages that are no campaigns go to the rejects."""
    out = str(tmp_path)
    subscribers = spark.range(3000).selectExpr(
        "id", "concat('c', id) as client_id", "if(id % 3 = 0, 'hot', concat('r', id % 50)) as restaurant_id")
    offer = lambda place, start=CAMPAIGN_NOW - 5: json.dumps({
        "restaurant_id": place, "adv_campaign_id": "a", "adv_campaign_datetime_start": start,
        "adv_campaign_datetime_end": CAMPAIGN_NOW + 5})
    texts = [offer("hot"), offer("r1"), offer("hot"), offer("nobody"), offer(None), offer("r2", "soon"), "{"]
    spark.createDataFrame([(t,) for t in texts], "value string").selectExpr(
        "value", "timestamp'2024-01-08 00:00:00' as timestamp").coalesce(1).write.parquet(f"{out}/in")
    stream = flow.message_stream(spark, "parquet", {}, f"{out}/in")
    seen = []

    def sink(df, batch_id):
        seen.append(len({f.split("__bucket=")[1].split("/")[0] for f in df.inputFiles() if "__bucket=" in f}))
        flow.table_sink(f"{out}/sent")(df, batch_id)

    jobs.campaign_job(stream, subscribers, out, sink, now=CAMPAIGN_NOW, buckets=64).awaitTermination()
    jobs.campaign_rejects_job(stream, out).awaitTermination()
    want = subscribers.where("restaurant_id in ('hot', 'r1')").select("client_id", "restaurant_id")
    assert values(spark.read.parquet(f"{out}/sent"), "client_id", "restaurant_id") == values(want)
    assert max(seen) <= 3
    assert values(spark.read.parquet(f"{out}/rejects"), "reason") == [
        ("broken",), ("broken",), ("missing restaurant_id",)]


def test_folders_of_other_threads_stay(spark):
    """A job that ends does not remove the folders of one that runs in another thread."""
    inside, ended = threading.Event(), threading.Event()

    def long_job():
        with work_folders_removed(spark):
            rows = stored(spark.range(3), "long")
            inside.set()
            ended.wait(60)
            return rows.count()

    with ThreadPoolExecutor(1) as pool:
        with work_folders_removed(spark):
            count = pool.submit(long_job)
            assert inside.wait(60)
        ended.set()
        assert count.result() == 3
