"""Business rules of the marts on hand-made rows."""

import re
from datetime import datetime
from decimal import Decimal

import pytest
from helpers import values
from pyspark.sql import functions as F

from martloom.functions.keys import uuid3
from martloom.plans import couriers, geo_marts, messenger, metrics, order_vault, settlement
from martloom.sources.events import geo_dimension


# --- couriers ------------------------------------------------------------------------

def ledger(spark, rates, sums, **options):
    rows = [("c", datetime(2024, 3, 5), r, Decimal(s), Decimal("10.00")) for r, s in zip(rates, sums)]
    fact = spark.createDataFrame(
        rows, "c string, order_ts timestamp_ntz, rate int, order_sum decimal(12,2), tip_sum decimal(12,2)").select(
        uuid3("c").alias("courier_id"), F.lit("o").alias("order_id"), "order_ts", "rate", "order_sum", "tip_sum")
    dim = spark.createDataFrame([("c", "Ann")], "courier_id string, name string").withColumn("id", uuid3("courier_id"))
    return couriers.courier_ledger(fact, dim, **options).first()


@pytest.mark.parametrize("rates, paid", [
    ([3, 4], 500),                                # 3.5
    ([4, 4], 700),                                # exactly 4.0
    ([4, 5], 800),                                # exactly 4.5
    ([5] * 9 + [4], 1000),                        # exactly 4.9
    ([5, 5], 1000),
])
def test_tiers(spark, rates, paid):
    sums = [str(Decimal(10000) / len(rates))] * len(rates)
    row = ledger(spark, rates, sums)
    assert row.courier_order_sum == paid
    assert row.orders_total_sum == 10000
    assert row.order_processing_fee == 2500
    assert row.courier_reward_sum == paid + Decimal("9.5") * len(rates)


@pytest.mark.parametrize("rates, floor", [([3], 100), ([4], 150), ([4, 5], 175), ([5], 200)])
def test_floors(spark, rates, floor):
    assert ledger(spark, rates, ["1.00"] * len(rates)).courier_order_sum == floor


def test_floor_per_order(spark):
    row = ledger(spark, [5, 5], ["100.00", "5000.00"], floor_per="order")
    assert row.courier_order_sum == 200 + 500


# --- settlement ------------------------------------------------------------------------

def test_settlement_rules(spark):
    def doc(key, status, day, items="[]"):
        text = ('{"_id":{"$oid":"%s"},"final_status":"%s","update_ts":{"$date":"%s 10:00:00Z"},"user":{"id":{"$oid":"u"}},'
                '"restaurant":{"id":{"$oid":"r"}},"order_items":%s}' % (key, status, day, items))
        return key, text, datetime(2024, 1, 1)

    two = '[{"id":{"$oid":"p"},"price":10.5,"quantity":2},{"id":{"$oid":"q"},"price":1,"quantity":1}]'
    docs = spark.createDataFrame([
        doc("o1", "CLOSED", "2024-01-01", two), doc("o11", "CLOSED", "2024-01-01", two),
        doc("o2", "CANCELLED", "2024-01-01", two), doc("o3", "CLOSED", "2024-02-01", two), ("bad", "{", None)],
        "object_id string, object_value string, update_ts timestamp_ntz")
    pay = ('{"order_id":"o11","product_payments":[{"product_id":"p","price":10,"quantity":1,"product_cost":10,'
           '"bonus_payment":%d,"bonus_grant":1}]}')
    outbox = spark.createDataFrame(
        [(2, "bonus_transaction", pay % 4), (1, "bonus_transaction", pay % 3), (3, "user_rank", "{}")],
        "id long, event_type string, event_value string")
    rest = spark.createDataFrame(
        [("r", '{"name":"Cafe"}', datetime(2023, 1, 1))], "object_id string, object_value string, update_ts timestamp_ntz")
    settled = settlement.settled_orders(docs)
    fact = settlement.fact_product_sales(settled, outbox)
    # o1 falls back to its items though its key is part of 'o11'; o11 takes its first bonus event.
    assert values(fact.where(F.col("order_id") == uuid3(F.lit("o1"))), "total_sum", "bonus_payment") == [
        (Decimal("1.00"), Decimal("0.00")), (Decimal("21.00"), Decimal("0.00"))]
    assert values(fact.where(F.col("order_id") == uuid3(F.lit("o11"))), "total_sum", "bonus_payment") == [
        (Decimal("10.00"), Decimal("3.00"))]
    report = settlement.settlement_report(
        fact, settlement.dim_orders(settled), settlement.dim_timestamps(settled), settlement.dim_restaurants(rest),
        "2024-02-01")
    row = report.collect()
    assert len(row) == 1
    assert (row[0].restaurant_name, row[0].orders_count, row[0].orders_total_sum) == ("Cafe", 2, Decimal("32.00"))
    assert row[0].order_processing_fee == Decimal("8.00")
    assert row[0].restaurant_reward_sum == Decimal("21.00")


# --- messenger ----------------------------------------------------------------------------

def test_event_changes(spark):
    rows = [(1, 1, 2, e, datetime(2024, 1, d)) for d, e in ((1, "add"), (2, "add"), (3, "leave"), (4, "add"))]
    rows.append((1, 5, 5, "add", datetime(2024, 1, 1)))
    log = spark.createDataFrame(rows, "group_id long, user_id long, user_id_from long, event string, event_dt timestamp_ntz")
    got = messenger.event_changes(log)
    assert values(got.where("user_id = 1").select("event", F.day("event_dt"))) == [("add", 1), ("add", 4), ("leave", 3)]
    assert got.where("user_id = 5").first().user_id_from is None


def staged(spark):
    users = spark.createDataFrame(
        [(n, f"u{n}", datetime(2020, 1, 1), "AU", 20) for n in (1, 2)],
        "id long, chat_name string, registration_dt timestamp_ntz, country string, age int")
    groups = spark.createDataFrame(
        [(n, 1, f"g{n}", datetime(2020, 1, min(n, 10)), False) for n in range(1, 13)],
        "id long, admin_id long, group_name string, registration_dt timestamp_ntz, is_private boolean")
    dialogs = spark.createDataFrame(
        [(10, 1, 1), (11, 9, 1), (12, 2, 1), (13, 1, None)], "message_id long, message_from long, message_group long"
    ).selectExpr("message_id", "timestamp_ntz'2024-01-01 00:00:00' as message_ts", "message_from",
                 "1L as message_to", "'x' as message", "message_group")
    log = spark.createDataFrame(
        [(1, 1, 3, "add", datetime(2024, 1, 1)), (1, 9, 3, "add", datetime(2024, 1, 1)), (2, 2, 3, "add", datetime(2024, 1, 1))],
        "group_id long, user_id long, user_id_from long, event string, event_dt timestamp_ntz")
    return users, groups, dialogs, log


def vault(spark):
    return messenger.messenger_vault(*staged(spark), "2024-02-01")


def test_links_need_both_parents(spark):
    v = vault(spark)
    assert v["link_user_message"].count() == 3      # message 11 is by an unknown user
    assert v["link_group_message"].count() == 3     # message 13 is private; empty groups give no row
    assert v["link_user_group"].count() == 2
    assert v["sat_auth_history"].count() == 2


def test_conversion_of_the_oldest_groups(spark):
    v = vault(spark)
    oldest = [r.group_id for r in messenger.oldest_groups(v["hub_groups"]).collect()]
    assert sorted(oldest) == list(range(1, 11))     # groups 10 to 12 registered together
    got = {r.hk_group_id: r for r in messenger.group_conversion(v).collect()}
    g1, g2 = [v["hub_groups"].where(f"group_id = {g}").first().hk_group_id for g in (1, 2)]
    assert (got[g1].cnt_added_users, got[g1].cnt_users_in_group_with_messages, got[g1].group_conversion) == (1, 2, 2.0)
    assert got[g2].cnt_users_in_group_with_messages is None
    members = {r.hk_group_id: r for r in messenger.group_conversion(v, members_only=True).collect()}
    assert members[g1].group_conversion == 1.0
    for only in (False, True):
        stored = values(messenger.group_conversion(v, members_only=only))
        assert values(messenger.staged_group_conversion(*staged(spark), members_only=only)) == stored


def shuffles(spark, make):
    """Shuffles of the final plan where no side is small enough to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        frame = make()
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return len(re.findall(r"^[ :+|-]*(?:\*\(\d+\) )?Exchange ", plan, re.M))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_shuffles_of_the_messenger_plans(spark):
    assert shuffles(spark, lambda: messenger.staged_group_conversion(*staged(spark))) <= 12
    assert shuffles(spark, lambda: vault(spark)["sat_auth_history"]) <= 7


# --- geo -------------------------------------------------------------------------------------

def stays(spark, *rows):
    return spark.createDataFrame(
        [(1, n, city, datetime(2024, *day), days) for n, (city, day, days) in enumerate(rows)],
        "user_id int, event_id int, city string, ts timestamp_ntz, duration int")


def test_home_city(spark):
    home = lambda *rows: geo_marts.home_city(stays(spark, *rows)).first().home_city
    assert home(("A", (1, 1), 28), ("B", (2, 1), 27), ("C", (3, 1), 26)) == "B"
    assert home(("A", (1, 1), 5), ("B", (1, 6), 20), ("C", (1, 26), 20)) == "C"
    # A long stay in a city counts from the last arrival in that city.
    assert home(("A", (1, 1), 30), ("B", (2, 1), 27), ("A", (3, 1), 2)) == "A"


def test_travel_lists(spark):
    s = stays(spark, *[("ABC"[n % 3], (1, 1 + n), 1) for n in range(5)])
    lists = geo_marts.travel_lists(geo_marts.travel_history(s))
    assert [r.travel_array for r in lists.collect()] == [["A", "B", "C", "A", "B"]]


def geo_log(spark, rows):
    """(event_id, kind, user, ts, lat, lng) as a nested log."""
    return spark.createDataFrame(rows, "event_id long, kind string, user long, ts string, lat double, lon double").selectExpr(
        "event_id",
        "struct(if(kind = 'message', event_id, null) as message_id, if(kind = 'message', user, null) as message_from,"
        " cast(null as long) as message_to, if(kind = 'message', ts, null) as message_ts,"
        " if(kind = 'message', null, ts) as datetime, if(kind = 'message', null, user) as user,"
        " if(kind = 'subscription', 1L, null) as subscription_channel, cast(null as string) as subscription_user,"
        " if(kind = 'reaction', 'like', null) as reaction_type) as event", "kind as event_type", "lat", "lon")


@pytest.fixture(scope="module")
def zones(spark):
    return geo_dimension(spark.createDataFrame(
        [(1, "Sydney", "-33,86", "151,20"), (2, "Mackay", "-21,14", "149,18"), (3, "Nowhere", "0,0", "x")],
        "id int, city string, lat string, lng string"))


def test_geo_dimension(zones):
    assert values(zones, "zone_id", "lat", "lng", "timezone") == [
        (1, -33.86, 151.2, "Australia/Sydney"), (2, -21.14, 149.18, "Australia/Brisbane"),
        (3, 0.0, None, "Australia/Sydney")]


def test_zone_stats_week_over_a_month_end(spark, zones):
    log = geo_log(spark, [
        (1, "reaction", 1, "2024-01-30 09:00:00", None, None),      # before the first message: no place
        (2, "message", 1, "2024-01-30 10:00:00", -33.8, 151.2),
        (3, "reaction", 1, "2024-02-01 10:00:00", None, None),      # same week as event 2
        (4, "message", 1, "2024-02-02 10:00:00", -21.1, 149.2),
    ])
    got = values(geo_marts.zone_stats(log, zones).select(
        F.month("month"), F.to_date("week").cast("string"), "zone_id", "week_message", "week_reaction", "week_user",
        "month_message", "month_reaction", "month_user"))
    assert got == sorted([
        (1, "2024-01-29", 1, 1, 1, 1, 1, 0, 1),
        (1, "2024-01-29", 2, 1, 0, 0, None, None, None),  # the zone has no counts in that month, but in that week
        (2, None, 1, None, None, None, 0, 1, 0),
        (2, None, 2, None, None, None, 1, 0, 0)], key=str)


def test_final_coordinates_come_from_one_event(spark):
    log = geo_log(spark, [
        (1, "message", 1, "2024-01-01 00:00:00", 1.0, 2.0), (2, "message", 1, "2024-01-02 00:00:00", 9.0, None),
        (3, "reaction", 1, "2024-01-03 00:00:00", None, None)])
    row = geo_marts.final_coordinates(log).first()
    assert (row.lat, row.lng, row.ts) == (1.0, 2.0, datetime(2024, 1, 3))


def test_user_geo_stats(spark, zones):
    log = geo_log(spark, [
        (1, "message", 1, "2024-01-01 00:00:00", -33.8, 151.2), (2, "message", 1, "2024-01-05 00:00:00", -33.9, 151.2),
        (3, "message", 1, "2024-02-10 00:00:00", -21.1, 149.2), (4, "message", 2, "2024-02-20 12:00:00", -33.8, 151.2)])
    got = {r.user_id: r for r in geo_marts.user_geo_stats(log, zones).collect()}
    assert (got[1].act_city, got[1].home_city, got[1].travel_count, got[1].travel_array) == (
        "Mackay", "Sydney", 2, ["Sydney", "Mackay"])
    assert got[1].local_time == datetime(2024, 2, 10, 10)
    assert got[2].local_time == datetime(2024, 2, 20, 23)


# --- order events -------------------------------------------------------------------------------

def order_text(key, items, user="u1", sent="2024-01-01 00:00:00"):
    lines = ",".join('{"id":"%s","name":"n%s","price":2.50,"quantity":1}' % (i, i) for i in items)
    return ('{"object_id":%d,"object_type":"order","sent_dttm":"%s","payload":{"date":"2024-01-01 00:00:00","cost":5.00,'
            '"payment":4.00,"final_status":"CLOSED","restaurant":{"id":"r1"},"user":{"id":"%s"},"order_items":[%s]}}'
            % (key, sent, user, lines))


def order_lines(spark, *texts):
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    users = spark.createDataFrame([("u1", "Ann", None), ("u2", "Bob", "bob")], "_id string, name string, login string")
    places = spark.createDataFrame(
        [("r1", "Cafe", [("a", "soup"), ("b", "cake"), ("a", "soup")])],
        "_id string, name string, menu array<struct<_id: string, category: string>>")
    raw = order_vault.parse_order_events(messages)
    # Through JSON, as between the services.
    enriched = order_vault.parse_enriched(order_vault.to_messages(order_vault.enrich_orders(raw, users, places)))
    return order_vault.order_lines(enriched)


def test_enrichment(spark):
    lines = order_lines(spark, order_text(1, "abx"), order_text(2, "b", "u2"), "{broken")
    assert values(lines, "order_id", "product_id", "category_name", "userlogin", "restaurant_name") == sorted([
        (1, "a", "soup", "login_was_not_loaded", "Cafe"), (1, "b", "cake", "login_was_not_loaded", "Cafe"),
        (1, "x", "unknown", "login_was_not_loaded", "Cafe"), (2, "b", "cake", "bob", "Cafe")], key=str)


def test_counters_count_orders_once(spark):
    lines = order_lines(spark, order_text(1, "aa"), order_text(1, "a"), order_text(2, "ab"))
    got = {r.product_name: r.order_cnt for r in order_vault.order_counters(lines, "product").collect()}
    assert got == {"na": 2, "nb": 1}
    assert {r.category_name: r.order_cnt for r in order_vault.order_counters(lines, "category").collect()} == {
        "soup": 2, "cake": 1}


def test_order_vault_sizes(spark):
    v = order_vault.order_vault(order_lines(spark, order_text(1, "ab"), order_text(1, "ab"), order_text(2, "b")), "2024-02-01")
    sizes = {name: df.count() for name, df in v.items()}
    assert sizes["h_order"] == 2 and sizes["h_product"] == 2 and sizes["l_order_product"] == 3
    assert sizes["s_order_cost"] == 2 and sizes["l_product_category"] == 2 and len(sizes) == 14
    for name, df in v.items():
        assert df.select(order_vault.primary_key(name)).distinct().count() == sizes[name]


def test_order_vault_from_rows(spark):
    """Tables without products come from the order rows: the same, and without the dictionaries they do not show."""
    messages = spark.createDataFrame([(order_text(1, "ab"),), (order_text(2, "b", "u2"),), (order_text(2, ""),)], "value string")
    users = spark.createDataFrame([("u1", "Ann", None), ("u2", "Bob", "bob")], "_id string, name string, login string")
    places = spark.createDataFrame(
        [("r1", "Cafe", [("a", "soup")])], "_id string, name string, menu array<struct<_id: string, category: string>>")
    enriched = order_vault.enrich_orders(order_vault.parse_order_events(messages), users, places)
    lines, rows = order_vault.order_lines(enriched), order_vault.order_rows(enriched)
    want, got = order_vault.order_vault(lines, "2024-02-01"), order_vault.order_vault(lines, "2024-02-01", rows=rows)
    for name, df in want.items():
        assert values(got[name].select(df.columns)) == values(df), name
    for name, joins in {"h_user": 0, "h_restaurant": 0, "h_order": 0, "l_order_user": 0, "s_order_cost": 0, "s_user_names": 1}.items():
        assert got[name]._jdf.queryExecution().optimizedPlan().toString().count("Join") == joins, name


# --- metrics --------------------------------------------------------------------------------------

def test_daily_metrics(spark):
    rows = [  # account, currency, status, amount, loaded
        (1, 430, "done", 100, 1), (1, 430, "done", 50, 1), (2, 430, "done", 10, 1), (2, 430, "queued", 999, 1),
        (-1, 430, "done", 999, 1), (3, 420, "done", 70, 1), (4, 460, "done", 5, 1)]
    tx = spark.createDataFrame(rows, "account_number_from long, currency_code int, status string, amount long, d int").selectExpr(
        "uuid() as operation_id", "*", "timestamp_ntz'2024-01-01 23:59:59' as transaction_dt",
        "timestamp_ntz'2024-01-02 00:00:00' as load_dt")
    rates = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' as date_update, 430 as currency_code, 420 as currency_code_with,"
        " cast(1.1 as decimal(5,3)) as currency_with_div, timestamp_ntz'2024-01-01 00:00:00' as load_dt"
        " union all select timestamp_ntz'2024-01-01 00:00:00', 430, 420, cast(1.5 as decimal(5,3)),"
        " timestamp_ntz'2024-01-03 00:00:00'")
    got = metrics.daily_metrics(tx, rates, "2024-01-05").collect()
    assert [(r.currency_from, r.amount_total, r.cnt_transactions, r.avg_transactions_per_account) for r in got] == [
        (430, Decimal("240"), 3, Decimal("80"))]
    assert metrics.daily_metrics(tx, rates, "2024-01-05", loaded_after="2024-01-02").count() == 0
    with_base = {r.currency_from: r.amount_total for r in
                 metrics.daily_metrics(tx, rates, "2024-01-05", base_as_one=True).collect()}
    assert with_base == {430: Decimal("240"), 420: Decimal("70")}

    more = tx.withColumn("amount", F.col("amount") * 2)
    first, second = metrics.daily_metrics(tx, rates, "2024-01-05"), metrics.daily_metrics(more, rates, "2024-01-06")
    assert metrics.merge_metrics(first, second).first().amount_total == 240
    assert metrics.merge_metrics(first, second, "upsert").first().amount_total == 480


def test_large_totals_fit(spark):
    tx = spark.range(3).selectExpr(
        "cast(id as string) as operation_id", "id + 1 as account_number_from", "430 as currency_code", "'done' as status",
        "9000000000000000 as amount", "timestamp_ntz'2024-01-01 00:00:00' as transaction_dt",
        "timestamp_ntz'2024-01-02 00:00:00' as load_dt")
    rates = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:00' as date_update, 430 as currency_code, 420 as currency_code_with,"
        " cast(2 as decimal(5,3)) as currency_with_div, timestamp_ntz'2024-01-01 00:00:00' as load_dt")
    assert metrics.daily_metrics(tx, rates, "2024-01-05").first().amount_total == Decimal(54000000000000000)
