"""Order-system dimensions, product-sales fact and the restaurant settlement report.

Surrogate keys are hashes of the natural key, so a fact computes its foreign
keys itself; no lookup join runs.  ``operators.joins.orphans`` reports keys
without a parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.keys import uuid3
from martloom.functions.text import document_id, document_time, with_document
from martloom.operators.writes import OPEN_END, first_per_key, versioned

# Final statuses, shares of the order sum.
SETTLED = ["CLOSED", "CANCELLED"]
PROCESSING_FEE = "0.25"
REWARD_SHARE = "0.75"


def dim_users(documents: DataFrame) -> DataFrame:
    latest = first_per_key(documents, ["object_id"], [F.desc("update_ts"), F.desc("object_value")])
    return with_document(latest, "object_value", schemas.USER_DOC).select(
        uuid3("object_id").alias("id"),
        F.col("object_id").alias("user_id"),
        F.col("doc.name").alias("user_name"),
        F.col("doc.login").alias("user_login"),
    )


def dim_restaurants(documents: DataFrame) -> DataFrame:
    """One row per restaurant, valid from its first document on, with its latest name."""
    parsed = with_document(documents, "object_value", schemas.RESTAURANT_DOC)
    return (
        parsed.groupBy("object_id")
        .agg(F.max_by("doc.name", F.struct("update_ts", "object_value")).alias("restaurant_name"),
             F.min("update_ts").alias("active_from"))
        .select(
            uuid3("object_id").alias("id"),
            F.col("object_id").alias("restaurant_id"),
            "restaurant_name", "active_from",
            F.lit(OPEN_END).cast("timestamp_ntz").alias("active_to"))
    )


PRODUCT = ["restaurant_id", "product_id"]


def menu_items(documents: DataFrame) -> DataFrame:
    """The menu items that restaurant documents state, each with the document's time."""
    items = with_document(documents, "object_value", schemas.RESTAURANT_DOC).select(
        F.col("object_id").alias("restaurant_id"), "update_ts", F.explode("doc.menu").alias("item"))
    return items.select(
        "restaurant_id",
        document_id("item._id").alias("product_id"),
        F.col("item.name").alias("product_name"),
        F.col("item.price").alias("product_price"),
        "update_ts",
    )


def product_versions(items: DataFrame) -> DataFrame:
    """Menu items as non-overlapping price versions, each with a key of its own."""
    return versioned(items, PRODUCT, ["product_name", "product_price"], "update_ts").withColumn(
        "id", uuid3("product_id", F.lit("|"), "active_from"))


def dim_products(documents: DataFrame) -> DataFrame:
    """Product versions of a whole log of restaurant documents."""
    return product_versions(menu_items(documents))


def merged_restaurants(old: DataFrame, new: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored and new rows of ``dim_restaurants`` as one row each: the first start, the name of the later document.

    ``updated`` tells which name is later; of equal moments the greater name stays.
    """
    last = documents.groupBy(F.col("object_id").alias("restaurant_id")).agg(F.max("update_ts").alias("updated"))
    both = old.unionByName(new.join(last, "restaurant_id").select(old.columns))
    return both.groupBy("id", "restaurant_id").agg(
        F.max_by("restaurant_name", F.struct("updated", "restaurant_name")).alias("restaurant_name"),
        F.min("active_from").alias("active_from"), F.max("active_to").alias("active_to"), F.max("updated").alias("updated"))


def settled_orders(documents: DataFrame) -> DataFrame:
    """Parsed order documents in a final status."""
    parsed = with_document(documents, "object_value", schemas.ORDER_DOC)
    return parsed.where(F.col("doc.final_status").isin(SETTLED)).select(
        F.col("object_id").alias("order_key"),
        F.col("doc.final_status").alias("order_status"),
        document_id("doc.user.id").alias("user_key"),
        document_id("doc.restaurant.id").alias("restaurant_key"),
        document_time("doc.update_ts").alias("ts"),
        F.col("doc.order_items").alias("order_items"),
    )


def _timestamp_key(ts: str) -> Column:
    return uuid3(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))


def dim_timestamps(settled: DataFrame) -> DataFrame:
    return settled.select("ts").distinct().select(
        _timestamp_key("ts").alias("id"), "ts",
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"),
        F.date_format("ts", "HH:mm:ss").alias("time"), F.to_date("ts").alias("date"))


def dim_orders(settled: DataFrame) -> DataFrame:
    return settled.select(
        uuid3("order_key").alias("id"), "order_key", "order_status",
        uuid3("user_key").alias("user_id"),
        uuid3("restaurant_key").alias("restaurant_id"),
        _timestamp_key("ts").alias("timestamp_id"))


def valid_version(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines (product_key, ts, ...) with ``version_id``, the key of the product version valid at ``ts``.

    An equi-join on the product, a range on the time.  The first version also
    holds for the time before it; a product without versions gives NULL.
    """
    first = products.groupBy("product_id").agg(F.min("active_from").alias("first_from"))
    versions = products.join(first, "product_id").select(
        F.col("product_id").alias("version_product"), F.col("id").alias("version_id"), "active_to",
        F.when(F.col("active_from") > F.col("first_from"), F.col("active_from")).alias("since"))
    valid = (
        (F.col("product_key") == F.col("version_product")) & (F.col("ts") < F.col("active_to"))
        & (F.col("since").isNull() | (F.col("ts") >= F.col("since"))))
    return lines.join(versions, valid, "left").drop("version_product", "active_to", "since")


def fact_product_sales(settled: DataFrame, bonus_events: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Lines of closed orders: from the order's first bonus event, else from the order itself.

    The bonus text is parsed first and joined on the order id inside it.  With
    the product dimension, ``product_id`` is the key of the version valid at
    the order's time; without, the key of the product whatever its version.
    """
    bonus = first_per_key(
        bonus_events.where("event_type = 'bonus_transaction'")
        .transform(with_document, "event_value", schemas.BONUS_EVENT)
        .select(F.col("doc.order_id").alias("order_key"), "id", F.col("doc.product_payments").alias("payments"))
        .where("order_key is not null"),
        ["order_key"], [F.col("id")],
    ).drop("id")
    own_lines = F.transform("order_items", lambda i: F.struct(
        document_id(i["id"]).alias("product_id"),
        i["price"].alias("price"),
        i["quantity"].alias("quantity"),
        (i["price"] * i["quantity"]).cast("decimal(12,2)").alias("product_cost"),
        F.lit(0).cast("decimal(12,2)").alias("bonus_payment"),
        F.lit(0).cast("decimal(12,2)").alias("bonus_grant")))
    closed = settled.where("order_status = 'CLOSED'").select("order_key", "ts", "order_items")
    lines = closed.join(bonus, "order_key", "left").select(
        "order_key", "ts", F.explode(F.coalesce("payments", own_lines)).alias("line"))
    if products is not None:
        lines = valid_version(lines.withColumn("product_key", F.col("line.product_id")), products)
    product = uuid3("line.product_id") if products is None else F.col("version_id")
    return lines.select(
        product.alias("product_id"),
        uuid3("order_key").alias("order_id"),
        F.col("line.quantity").alias("count"),
        F.col("line.price").alias("price"),
        F.col("line.product_cost").alias("total_sum"),
        F.col("line.bonus_payment").alias("bonus_payment"),
        F.col("line.bonus_grant").alias("bonus_grant"))


def settlement_report(
    fact: DataFrame, orders: DataFrame, timestamps: DataFrame, restaurants: DataFrame, as_of
) -> DataFrame:
    """Sums per restaurant and day of closed orders before ``as_of``.

    Every join comes after an aggregation: lines to orders, orders to
    (restaurant, timestamp), timestamps to days.
    """
    sums = ["order_sum", "bonus_sum", "grant_sum"]
    per_order = fact.groupBy("order_id").agg(
        F.sum("total_sum").alias("order_sum"),
        F.sum("bonus_payment").alias("bonus_sum"),
        F.sum("bonus_grant").alias("grant_sum"))
    closed = orders.where("order_status = 'CLOSED'").select(
        F.col("id").alias("order_id"), "restaurant_id", "timestamp_id")
    per_moment = (
        per_order.join(closed, "order_id")
        .groupBy("restaurant_id", "timestamp_id")
        .agg(F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in sums]))
    days = timestamps.where(F.col("date") < F.lit(as_of).cast("date")).select(
        F.col("id").alias("timestamp_id"), F.col("date").alias("settlement_date"))
    per_day = (
        per_moment.join(days, "timestamp_id")
        .groupBy("restaurant_id", "settlement_date")
        .agg(F.sum("orders").alias("orders_count"),
             F.sum("order_sum").alias("orders_total_sum"),
             F.sum("bonus_sum").alias("orders_bonus_payment_sum"),
             F.sum("grant_sum").alias("orders_bonus_granted_sum")))
    names = restaurants.select(
        F.col("id").alias("restaurant_id"), F.col("restaurant_id").alias("source_id"), "restaurant_name")
    total = F.col("orders_total_sum").cast("decimal(28,2)")
    return per_day.join(names, "restaurant_id", "left").select(
        F.col("source_id").alias("restaurant_id"), "restaurant_name", "settlement_date",
        "orders_count", "orders_total_sum", "orders_bonus_payment_sum", "orders_bonus_granted_sum",
        (total * F.lit(PROCESSING_FEE).cast("decimal(4,2)")).alias("order_processing_fee"),
        (total * F.lit(REWARD_SHARE).cast("decimal(4,2)")
         - F.col("orders_bonus_payment_sum").cast("decimal(28,2)")).alias("restaurant_reward_sum"))
