"""The driver's tables seen as the inputs of the jobs.

Everything is derived from whole tables by projections, joins and aggregates.
Nested values have a small fixed bound (``MENU_SIZE`` entries at most).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.plans.order_vault import to_messages
from martloom.sources.events import CAPITAL_OF, ZONE_CITIES

CITIES = [*CAPITAL_OF, *ZONE_CITIES]
AS_OF = "2001-06-01"
LOAD_DT = "2024-02-01 00:00:00"
CAMPAIGN_NOW = 1704672000  # 2024-01-08 00:00:00 UTC
K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
MENU_SIZE = 10
# Days that move deliveries behind the date a first load starts from.
DELIVERY_SHIFT = 11_000


class Inputs:
    """Lazily built input frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """A table for costly row work.  A small file is one row group, hence one task:
        its rows are spread over the cores.  A table of many files is left as it is."""
        df, cores = self.table(name), self.spark.sparkContext.defaultParallelism
        return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df

    # --- geo events -------------------------------------------------------

    @cached_property
    def geo_raw(self) -> DataFrame:
        """Zone file: coordinates as text with a decimal comma; the 25th city has no time zone of its own."""
        names = ", ".join(f"'{c}'" for c in CITIES)
        return self.table("nation").selectExpr(
            "n_nationkey as id",
            f"coalesce(get(array({names}), n_nationkey), n_name) as city",
            "replace(cast(cast(-12 - n_nationkey * 1.2 as decimal(9,2)) as string), '.', ',') as lat",
            "replace(cast(cast(114 + ((n_nationkey * 7) % 25) * 1.5 as decimal(9,2)) as string), '.', ',') as lng")

    @cached_property
    def geo_events(self) -> DataFrame:
        """Nested event log; only messages carry coordinates."""
        e = self.table("events").selectExpr(
            "*", f"{K} as k", "event_type in ('view', 'click') as is_message",
            "case when user_id % 3 = 0 then user_id % 25"
            " else (user_id + floor(day(ts) / 10)) % 25 end as z")
        return e.selectExpr(
            "event_id",
            "struct(if(is_message, event_id, null) as message_id,"
            " if(is_message, user_id, null) as message_from,"
            " if(is_message, abs(user_id + k % 40 - 20), null) as message_to,"
            " if(is_message, cast(ts as string), null) as message_ts,"
            " if(is_message, null, cast(ts as string)) as datetime,"
            " if(is_message, null, user_id) as user,"
            " if(event_type = 'signup', k, null) as subscription_channel,"
            " cast(null as string) as subscription_user,"
            " case event_type when 'purchase' then 'like' when 'error' then 'dislike' end as reaction_type"
            ") as event",
            "case when is_message then 'message' when event_type = 'signup' then 'subscription'"
            " else 'reaction' end as event_type",
            "if(is_message, -12.0D - z * 1.2D + (event_id % 10) * 0.001D, null) as lat",
            "if(is_message, 114.0D + ((z * 7) % 25) * 1.5D + (event_id % 7) * 0.001D, null) as lon",
            "cast(ts as date) as date")

    # --- messenger --------------------------------------------------------

    @cached_property
    def group_log(self) -> DataFrame:
        return self.table("events").where("event_type in ('signup', 'error')").selectExpr(
            f"cast({K} % 20 as bigint) as group_id", "user_id", "abs(user_id + event_id % 5 - 2) as user_id_from",
            "if(event_type = 'signup', 'add', 'leave') as event", "ts as event_dt")

    @cached_property
    def groups(self) -> DataFrame:
        return (
            self.table("events").groupBy(F.expr(f"cast({K} % 20 as bigint)").alias("id"))
            .agg(F.min("user_id").alias("admin_id"), F.min("ts").alias("registration_dt"))
            .selectExpr("id", "admin_id", "concat('group ', id) as group_name", "registration_dt",
                        "id % 4 = 0 as is_private"))

    @cached_property
    def users(self) -> DataFrame:
        """Customers in the black; others write messages but are not registered."""
        nation = self.table("nation").selectExpr("n_nationkey as c_nationkey", "n_name as country")
        return (
            self.table("customer").where("c_acctbal >= 0").join(nation, "c_nationkey", "left")
            .selectExpr(
                "c_custkey as id", "c_name as chat_name",
                "timestampadd(DAY, cast(c_custkey % 1000 as int), timestamp_ntz'2020-01-01 00:00:00') as registration_dt",
                "country", "cast(18 + c_custkey % 60 as int) as age"))

    @cached_property
    def dialogs(self) -> DataFrame:
        """Views are group messages, clicks are private ones."""
        return self.table("events").where("event_type in ('view', 'click')").selectExpr(
            "event_id as message_id", "ts as message_ts", "user_id as message_from",
            f"abs(user_id + {K} % 40 - 20) as message_to", "props as message",
            f"if(event_type = 'view', cast({K} % 20 as bigint), null) as message_group")

    # --- orders and deliveries ---------------------------------------------

    @cached_property
    def order_documents(self) -> DataFrame:
        """Orders as extended-JSON documents with one to three items."""
        body = self.spread("orders", "o_orderkey").selectExpr(
            "cast(o_orderkey as string) as object_id", "o_orderdate as update_ts",
            "struct(struct(cast(o_orderkey as string) as `$oid`) as _id,"
            " case o_orderstatus when 'F' then 'CLOSED' when 'P' then 'CANCELLED' else 'OPEN' end as final_status,"
            " struct(concat(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), 'Z') as `$date`) as update_ts,"
            " struct(struct(cast(o_custkey as string) as `$oid`) as id) as user,"
            " struct(struct(cast(o_custkey as string) as `$oid`) as id) as restaurant,"
            " transform(sequence(0, cast(o_orderkey % 3 as int)), i -> struct("
            f"  struct(cast(o_custkey * {MENU_SIZE} + (o_orderkey + i * 3) % {MENU_SIZE} as string) as `$oid`) as id,"
            "  cast(cast(o_totalprice as decimal(12,2)) + i as decimal(12,2)) as price,"
            "  cast(1 + (o_orderkey + i) % 5 as int) as quantity)) as order_items) as doc")
        return body.select("object_id", F.to_json("doc").alias("object_value"), "update_ts")

    @cached_property
    def restaurant_documents(self) -> DataFrame:
        """Two versions of each restaurant; the second raises every other price."""
        v = self.spread("customer", "c_custkey").withColumn("version", F.explode(F.sequence(F.lit(1), F.lit(2))))
        body = v.selectExpr(
            "cast(c_custkey as string) as object_id",
            "timestampadd(MONTH, version - 1, timestamp_ntz'2022-01-01 00:00:00') as update_ts",
            "struct(struct(cast(c_custkey as string) as `$oid`) as _id, c_name as name,"
            f" transform(sequence(0, {MENU_SIZE - 1}), j -> struct("
            f"  struct(cast(c_custkey * {MENU_SIZE} + j as string) as `$oid`) as _id,"
            "  concat('dish ', j) as name,"
            "  cast(100 + c_custkey % 90 + if(version = 2 and j % 2 = 0, 5, 0) as decimal(12,2)) as price"
            ")) as menu) as doc")
        return body.select("object_id", F.to_json("doc").alias("object_value"), "update_ts")

    @cached_property
    def user_documents(self) -> DataFrame:
        body = self.table("customer").selectExpr(
            "cast(c_custkey as string) as object_id",
            "timestampadd(DAY, cast(c_custkey % 28 as int), timestamp_ntz'2022-01-01 00:00:00') as update_ts",
            "struct(struct(cast(c_custkey as string) as `$oid`) as _id, c_name as name,"
            " concat(lower(c_mktsegment), '_', c_custkey) as login) as doc")
        return body.select("object_id", F.to_json("doc").alias("object_value"), "update_ts")

    @cached_property
    def outbox(self) -> DataFrame:
        """Events of the bonus system: urgent and high orders earn a bonus, urgent ones are sent twice."""
        paid = "cast(cast(o_totalprice as decimal(12,2)) + i as decimal(12,2))"
        o = self.spread("orders", "o_orderkey").withColumn(
            "copy", F.explode(F.expr("if(o_orderpriority = '1-URGENT', array(0, 1), array(0))")))
        body = o.selectExpr(
            "o_orderkey * 2 + copy + 1 as id", "o_orderdate as event_ts",
            "if(o_orderpriority in ('1-URGENT', '2-HIGH'), 'bonus_transaction', 'user_balance') as event_type",
            "struct(cast(o_custkey as string) as user_id, cast(o_orderkey as string) as order_id,"
            " transform(sequence(0, cast(o_orderkey % 3 as int)), i -> struct("
            f"  cast(o_custkey * {MENU_SIZE} + (o_orderkey + i * 3) % {MENU_SIZE} as string) as product_id,"
            f"  {paid} as price, cast(1 as int) as quantity, {paid} as product_cost,"
            "  cast(10 + i + copy as decimal(12,2)) as bonus_payment,"
            "  cast(o_orderkey % 7 as decimal(12,2)) as bonus_grant)) as product_payments) as body")
        return body.select("id", "event_ts", "event_type", F.to_json("body").alias("event_value"))

    @cached_property
    def delivery_rows(self) -> DataFrame:
        rate = (
            "cast(case when l_suppkey % 6 = 0 then 3 + q % 3"
            " else 5 - if(q % (1 + l_suppkey % 6) = 0, 1, 0) end as int)")
        lines = self.spread("lineitem", "l_orderkey").selectExpr("*", "cast(l_quantity as int) as q")
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
            "cast(l_orderkey as string) as order_id",
            "o_orderdate as order_ts",
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as delivery_id",
            "cast(l_suppkey as string) as courier_id",
            "concat('Street ', l_partkey % 50, ', ', l_partkey % 200, ', apt ', l_linenumber) as address",
            f"timestampadd(MILLISECOND, 250, timestampadd(DAY, {DELIVERY_SHIFT}, l_shipdate)) as delivery_ts",
            f"{rate} as rate",
            "cast(l_extendedprice as decimal(12,2)) as sum",
            "cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(12,2)) as tip_sum")

    @cached_property
    def delivery_content(self) -> DataFrame:
        texts = self.delivery_rows.withColumns({
            "order_ts": F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss"),
            "delivery_ts": F.date_format("delivery_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")})
        return texts.select(F.to_json(F.struct("*")).alias("content"))

    @cached_property
    def courier_content(self) -> DataFrame:
        """Suppliers in the black are the couriers the service lists."""
        return self.table("supplier").where("s_acctbal >= 0").select(
            F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_name").alias("name")))
            .alias("content"))

    # --- order events -------------------------------------------------------

    @cached_property
    def order_events(self) -> DataFrame:
        """One message per order line with one or two dishes of one kitchen; some objects are sent again."""
        return self.dealt_order_events()

    def dealt_order_events(self, files: int | None = None) -> DataFrame:
        """``order_events``, dealt into ``files`` as narrow rows, before text makes them wide."""
        lines = self.spread("lineitem", "l_orderkey")
        orders = self.table("orders")
        dish = "concat('dish ', {0}) as name"
        first, second = "l_partkey", f"floor(l_partkey / {MENU_SIZE}) * {MENU_SIZE} + (l_partkey + 3) % {MENU_SIZE}"
        item = lambda part: (
            f"struct(cast({part} as string) as id, {dish.format(part)},"
            " cast(l_extendedprice as decimal(12,2)) as price, cast(l_quantity as int) as quantity)")
        named = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity",
                 "o_orderdate", "o_orderstatus", "o_custkey"]
        rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(*named)
        if files:
            rows = rows.repartition(files, *named)
        body = rows.selectExpr(
            "l_orderkey * 8 + l_linenumber as object_id", "'order' as object_type",
            "date_format(timestampadd(SECOND, cast(l_partkey % 86400 as int), l_shipdate), 'yyyy-MM-dd HH:mm:ss')"
            " as sent_dttm",
            "struct(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') as date,"
            " cast(l_extendedprice as decimal(12,2)) as cost, cast(l_extendedprice as decimal(12,2)) as payment,"
            " case o_orderstatus when 'F' then 'CLOSED' when 'P' then 'CANCELLED' else 'OPEN' end as final_status,"
            f" struct(cast(floor(l_partkey / {MENU_SIZE}) as string) as id) as restaurant,"
            " struct(cast(o_custkey as string) as id) as user,"
            f" if(l_quantity > 25, array({item(first)}, {item(second)}), array({item(first)})) as order_items"
            ") as payload")
        return to_messages(body)

    @cached_property
    def user_entries(self) -> DataFrame:
        """User dictionary; some users have no login."""
        return self.table("customer").selectExpr(
            "cast(c_custkey as string) as _id", "c_name as name",
            "if(c_mktsegment = 'BUILDING', null, concat('login_', c_custkey)) as login")

    @cached_property
    def restaurant_entries(self) -> DataFrame:
        """Kitchens of ten dishes; large ones are off the menu."""
        menu = F.expr("collect_list(if(p_size <= 45, struct(cast(p_partkey as string) as _id, p_type as category), null))")
        return (
            self.table("part").groupBy(F.expr(f"cast(floor(p_partkey / {MENU_SIZE}) as string)").alias("_id"))
            .agg(menu.alias("menu")).selectExpr("_id", "concat('kitchen ', _id) as name", "menu"))

    # --- transactions -------------------------------------------------------

    @cached_property
    def transactions(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        orders = self.table("orders")
        return orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
            "cast(o_orderkey as string) as operation_id",
            "o_custkey - 5 as account_number_from", "o_custkey + 7 as account_number_to",
            "c_nationkey as currency_code", "concat('country ', c_nationkey) as country",
            "case o_orderstatus when 'F' then 'done' when 'P' then 'in_progress' else 'queued' end as status",
            "'sbp_incoming' as transaction_type",
            "cast(cast(o_totalprice as decimal(14,2)) * 100 as bigint) as amount",
            "timestampadd(SECOND, cast(o_orderkey % 86400 as int), o_orderdate) as transaction_dt",
            "timestampadd(DAY, 1, o_orderdate) as load_dt", "'S3' as load_src")

    @cached_property
    def currencies(self) -> DataFrame:
        """Rates of currencies 1 to 23 to currency 0 for each order day; currency 24 has none."""
        days = self.table("orders").select(F.col("o_orderdate").alias("date_update")).distinct()
        return days.withColumn("currency_code", F.explode(F.sequence(F.lit(1), F.lit(23)))).selectExpr(
            "date_update", "currency_code", "0 as currency_code_with",
            "cast(1 + currency_code * 0.01 as decimal(5,3)) as currency_with_div",
            "date_update as load_dt", "'S3' as load_src")

    @cached_property
    def envelopes(self) -> DataFrame:
        """Transactions and currencies as one mixed message feed."""
        stamp = "yyyy-MM-dd HH:mm:ss"
        t = self.transactions.drop("load_dt", "load_src").withColumn(
            "transaction_dt", F.date_format("transaction_dt", stamp))
        c = self.currencies.drop("load_dt", "load_src").withColumn(
            "date_update", F.date_format("date_update", stamp))
        envelope = lambda df, kind, object_id, sent: df.select(F.to_json(F.struct(
            object_id.alias("object_id"), F.lit(kind).alias("object_type"), F.col(sent).alias("sent_dttm"),
            F.struct(*df.columns).alias("payload"))).alias("value"))
        return envelope(t, "TRANSACTION", F.col("operation_id"), "transaction_dt").unionByName(
            envelope(c, "CURRENCY", F.concat_ws("-", "currency_code", "date_update"), "date_update"))

    # --- campaigns ----------------------------------------------------------

    @cached_property
    def campaign_messages(self) -> DataFrame:
        """Purchases announce campaigns; all messages of one campaign of a restaurant are alike."""
        body = self.table("events").where("event_type = 'purchase'").selectExpr(
            "ts", f"{K} as k", "cast(event_id % 50 as int) as c").selectExpr(
            "cast(ts as timestamp) as timestamp",
            "struct(cast(k as string) as restaurant_id, cast(c as string) as adv_campaign_id,"
            " concat('content ', c) as adv_campaign_content, concat('owner ', k) as adv_campaign_owner,"
            " concat('info', k, '@example.org') as adv_campaign_owner_contact,"
            f" cast({CAMPAIGN_NOW} + (k - 50) * 3600 as bigint) as adv_campaign_datetime_start,"
            f" cast({CAMPAIGN_NOW} + (c - 10) * 3600 as bigint) as adv_campaign_datetime_end,"
            f" cast({CAMPAIGN_NOW} - 86400 + c as bigint) as datetime_created) as body")
        return body.select(F.to_json("body").alias("value"), "timestamp")

    @cached_property
    def subscribers(self) -> DataFrame:
        """Views are subscriptions; repeated ones are duplicates."""
        return self.table("events").where("event_type = 'view'").selectExpr(
            "event_id as id", "cast(user_id as string) as client_id", f"cast({K} as string) as restaurant_id")
