"""Delivery dimensions and fact, and the courier payout ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.keys import known_uuid3, uuid3
from martloom.functions.text import address_parts, json_rejects, with_parsed
from martloom.operators.joins import with_placeholders
from martloom.operators.writes import first_per_key

# Payout tiers, fixed values: rating below, share of the order sum, floor.
TIERS = [("4", "0.05", "100"), ("4.5", "0.07", "150"), ("4.9", "0.08", "175")]
TOP_TIER = ("0.10", "200")
PROCESSING_FEE = "0.25"
TIPS_SHARE = "0.95"
# Name of an unknown courier, city of an address without one.
PLACEHOLDER_PREFIX = "Курьер-нелегал #"
DEFAULT_CITY = "Moscow"


def parse_couriers(landed: DataFrame) -> DataFrame:
    parsed = with_parsed(landed, "content", schemas.COURIER, keep=[])
    named = parsed.withColumnRenamed("_id", "courier_id")
    return first_per_key(named.where("courier_id is not null"), ["courier_id"], [F.col("name")])


def parse_restaurants(landed: DataFrame) -> DataFrame:
    """Restaurants of the delivery service: (id, restaurant_id, name)."""
    return parse_couriers(landed).select(
        uuid3("courier_id").alias("id"), F.col("courier_id").alias("restaurant_id"), "name")


def parse_deliveries(landed: DataFrame) -> DataFrame:
    """Typed deliveries; a text without the ids of order, delivery and courier is broken and left out."""
    parsed = with_parsed(landed, "content", schemas.DELIVERY, keep=[])
    return parsed.dropna(subset=["order_id", "delivery_id", "courier_id"]).withColumns({
        "order_ts": F.to_timestamp_ntz("order_ts"), "delivery_ts": F.to_timestamp_ntz("delivery_ts")})


def delivery_rejects(landed: DataFrame) -> DataFrame:
    """Delivery texts that are broken or lack an id, with the reason."""
    return json_rejects(landed, "content", schemas.DELIVERY, ["order_id", "delivery_id", "courier_id"])


def dim_couriers(couriers: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Known couriers, and a placeholder for each courier only deliveries mention."""
    placeholder = F.concat(F.lit(PLACEHOLDER_PREFIX), F.col("courier_id"))
    return with_placeholders(couriers, deliveries, "courier_id", {"name": placeholder}).select(
        uuid3("courier_id").alias("id"), "courier_id", "name")


def dim_addresses(deliveries: DataFrame) -> DataFrame:
    distinct = deliveries.select(F.col("address").alias("full_address")).distinct()
    return distinct.select(
        uuid3("full_address").alias("id"), "full_address", F.lit(DEFAULT_CITY).alias("city"),
        *[part.alias(name) for name, part in address_parts(F.col("full_address")).items()])


def dim_delivery_orders(deliveries: DataFrame) -> DataFrame:
    """One row per order: (id, order_id, order_ts)."""
    first = deliveries.groupBy("order_id").agg(F.min("order_ts").alias("order_ts"))
    return first.select(uuid3("order_id").alias("id"), "order_id", "order_ts")


def dim_deliveries(deliveries: DataFrame) -> DataFrame:
    one = first_per_key(deliveries, ["delivery_id"], [F.col("delivery_ts"), F.col("courier_id"), F.col("address")])
    return one.select(
        uuid3("delivery_id").alias("id"), "delivery_id",
        uuid3("courier_id").alias("courier_id"), uuid3("address").alias("address_id"),
        "delivery_ts", "rate")


def fact_deliveries(deliveries: DataFrame) -> DataFrame:
    """Delivery sums with hashed keys; the courier, rating and order time come along.

    With them the ledger needs no join of the fact to tables of its own size.
    """
    return deliveries.select(
        known_uuid3("order_id").alias("order_id"), known_uuid3("delivery_id").alias("delivery_id"),
        known_uuid3("courier_id").alias("courier_id"), "order_ts", "rate",
        F.col("sum").alias("order_sum"), "tip_sum")


def courier_monthly(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("courier_id", F.year("order_ts").alias("year"), F.month("order_ts").alias("month"))
        .agg(F.count("order_id").alias("orders_count"),
             F.sum("order_sum").alias("orders_total_sum"),
             F.sum("tip_sum").alias("tip_sum"),
             F.avg("rate").alias("rate"),
             F.sum(_at_least(F.col("order_sum"), "0.05", "100")).alias("paid_low"),
             F.sum(_at_least(F.col("order_sum"), "0.07", "150")).alias("paid_mid"),
             F.sum(_at_least(F.col("order_sum"), "0.08", "175")).alias("paid_high"),
             F.sum(_at_least(F.col("order_sum"), "0.10", "200")).alias("paid_top")))


def _at_least(amount: Column, share: str, floor: str) -> Column:
    """Share of an amount, but no less than the floor."""
    money = "decimal(24,4)"
    part = amount.cast("decimal(20,2)") * F.lit(share).cast("decimal(4,2)")
    return F.greatest(part.cast(money), F.lit(floor).cast(money))


def _by_rating(rate: Column, payouts: list[Column]) -> Column:
    """The payout of the tier the rating falls into; the last tier has no upper limit."""
    out = F.when(rate < F.lit(float(TIERS[0][0])), payouts[0])
    for (limit, _, _), payout in zip(TIERS[1:], payouts[1:]):
        out = out.when(rate < F.lit(float(limit)), payout)
    return out.otherwise(payouts[-1])


def courier_ledger(fact: DataFrame, couriers: DataFrame, floor_per: str = "month") -> DataFrame:
    """Monthly payout per courier.

    ``floor_per="month"`` applies the floor to the month's total;
    ``"order"`` applies it to each order.
    """
    monthly = courier_monthly(fact)
    total = F.col("orders_total_sum")
    if floor_per == "order":
        payouts = [F.col(c) for c in ("paid_low", "paid_mid", "paid_high", "paid_top")]
    else:
        payouts = [_at_least(total, share, floor) for _, share, floor in TIERS] + [_at_least(total, *TOP_TIER)]
    paid = monthly.withColumn("courier_order_sum", _by_rating(F.col("rate"), payouts))
    names = couriers.select(
        F.col("id").alias("courier_id"), F.col("courier_id").alias("source_id"), F.col("name").alias("courier_name"))
    return paid.join(names, "courier_id", "left").select(
        F.col("source_id").alias("courier_id"), "courier_name",
        F.col("year").alias("settlement_year"), F.col("month").alias("settlement_month"),
        "orders_count", "orders_total_sum", F.col("rate").alias("rate_avg"),
        (total.cast("decimal(28,2)") * F.lit(PROCESSING_FEE).cast("decimal(4,2)")).alias("order_processing_fee"),
        "courier_order_sum",
        F.col("tip_sum").alias("courier_tips_sum"),
        (F.col("courier_order_sum").cast("decimal(30,4)")
         + F.col("tip_sum").cast("decimal(28,4)") * F.lit(TIPS_SHARE).cast("decimal(4,2)")
         ).alias("courier_reward_sum"))
