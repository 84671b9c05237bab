"""Order events: enrichment, vault and counters.  Batch and stream share these functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.keys import uuid3
from martloom.functions.text import json_rejects, with_checked, with_parsed
from martloom.operators.vault import hub, lineage, link, satellite

# Source name in the vault, stand-ins for what the dictionaries lack.
LOAD_SRC = "Kafka-stg-service-orders"
NO_LOGIN = "login_was_not_loaded"
NO_CATEGORY = "unknown"


def parse_order_events(messages: DataFrame) -> DataFrame:
    """Message texts (column ``value``) to raw order rows; the payload stays text."""
    parsed = with_parsed(messages, "value", schemas.ORDER_EVENT, keep=["value"]).where("object_id is not null")
    return parsed.select(
        "object_id", "object_type", F.to_timestamp_ntz("sent_dttm").alias("sent_dttm"), "payload",
        F.get_json_object("value", "$.payload").alias("payload_text"))


def checked_order_events(messages: DataFrame) -> DataFrame:
    """``parse_order_events`` of every message, with its text and the ``reason`` of those that are no order event."""
    return with_checked(messages.select("value"), "value", schemas.ORDER_EVENT, ["object_id"]).select(
        "value", "object_id", "object_type", F.to_timestamp_ntz("sent_dttm").alias("sent_dttm"), "payload",
        F.get_json_object("value", "$.payload").alias("payload_text"), "reason")


def order_rejects(messages: DataFrame) -> DataFrame:
    """Messages that are no order event, with the reason."""
    return json_rejects(messages, "value", schemas.ORDER_EVENT, ["object_id"])


def _menu_map(menu: str) -> Column:
    """Category by item id.  If a menu lists an item more than once, the smallest category counts."""
    items = F.array_distinct(F.transform(menu, lambda m: m["_id"]))
    smallest = lambda item: F.array_min(F.transform(
        F.filter(menu, lambda m: m["_id"] == item), lambda m: m["category"]))
    return F.when(
        F.size(items) == F.size(menu), F.map_from_entries(F.transform(menu, lambda m: F.struct(m["_id"], m["category"])))
    ).otherwise(F.map_from_entries(F.transform(items, lambda item: F.struct(item, smallest(item)))))


def enrich_orders(orders: DataFrame, users: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Add user names, restaurant names and product categories to raw orders.

    A restaurant's menu becomes a map, so the categories are looked up inside
    the row: the items are neither exploded nor collected again.  An item that
    is not on the menu gets the category ``unknown``.
    """
    user_side = users.select(
        F.col("_id").alias("user_key"), F.col("name").alias("user_name"), F.col("login").alias("user_login"))
    restaurants = restaurants.withColumn("menu", F.filter("menu", lambda m: m["_id"].isNotNull()))
    restaurant_side = restaurants.select(
        F.col("_id").alias("restaurant_key"), F.col("name").alias("restaurant_name"),
        _menu_map("menu").alias("categories"))
    keyed = orders.withColumns({
        "user_key": F.col("payload.user.id"), "restaurant_key": F.col("payload.restaurant.id")})
    category = lambda item: F.coalesce(F.try_element_at("categories", item["id"]), F.lit(NO_CATEGORY))
    products = F.transform("payload.order_items", lambda i: F.struct(
        i["id"].alias("id"), i["price"].alias("price"), i["quantity"].alias("quantity"),
        i["name"].alias("name"), category(i).alias("category")))
    return (
        keyed.join(user_side, "user_key", "left").join(restaurant_side, "restaurant_key", "left")
        .select("object_id", "object_type", F.struct(
            F.col("object_id").alias("id"), "payload.date", "payload.cost", "payload.payment",
            F.col("payload.final_status").alias("status"),
            F.struct(F.col("restaurant_key").alias("id"), F.col("restaurant_name").alias("name")).alias("restaurant"),
            F.struct(F.col("user_key").alias("id"), F.col("user_name").alias("name"),
                     F.col("user_login").alias("login")).alias("user"),
            products.alias("products")).alias("payload")))


def to_messages(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return rows.select(F.to_json(F.struct(*(columns or rows.columns))).alias("value"))


def parse_enriched(messages: DataFrame) -> DataFrame:
    return with_parsed(messages, "value", schemas.ENRICHED_ORDER, keep=[])


def order_rows(enriched: DataFrame) -> DataFrame:
    """One row per order event: its business keys and attributes, and the ``products`` as they are.

    Flat columns, so that a reader of a few of them moves no others through the joins of the enrichment.
    """
    p = "payload"
    return enriched.select(
        F.col(f"{p}.id").alias("order_id"), F.to_timestamp_ntz(f"{p}.date").alias("order_dt"),
        F.col(f"{p}.cost").alias("cost"), F.col(f"{p}.payment").alias("payment"),
        F.col(f"{p}.status").alias("status"),
        F.col(f"{p}.user.id").alias("user_id"), F.col(f"{p}.user.name").alias("username"),
        F.coalesce(F.col(f"{p}.user.login"), F.lit(NO_LOGIN)).alias("userlogin"),
        F.col(f"{p}.restaurant.id").alias("restaurant_id"),
        F.col(f"{p}.restaurant.name").alias("restaurant_name"),
        F.col(f"{p}.products").alias("products"))


def order_lines(enriched: DataFrame) -> DataFrame:
    """One row per product of each order, with its business keys and attributes."""
    return order_rows(enriched).select("*", F.explode_outer("products").alias("product")).select(
        "*", F.col("product.id").alias("product_id"), F.col("product.name").alias("product_name"),
        F.col("product.category").alias("category_name"), F.col("product.quantity").alias("quantity"),
    ).drop("products", "product")


BUSINESS_KEY = {
    "user": "user_id", "product": "product_id", "category": "category_name",
    "restaurant": "restaurant_id", "order": "order_id"}
LINKS = ["order_product", "product_restaurant", "product_category", "order_user"]
# Satellite: hub it belongs to, and line column -> satellite column.
SATELLITES = {
    "order_cost": ("order", {"cost": "cost", "payment": "payment"}),
    "order_status": ("order", {"status": "status"}),
    "product_names": ("product", {"product_name": "name"}),
    "restaurant_names": ("restaurant", {"restaurant_name": "name"}),
    "user_names": ("user", {"username": "username", "userlogin": "userlogin"}),
}


def order_vault(
    lines: DataFrame, load_dt: str | Column, load_src: str = LOAD_SRC, rows: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The fourteen vault tables by name.

    ``rows`` are the ``order_rows`` of the same orders, if they are at hand: tables without products are made from
    them.  As these are distinct, a dictionary a table does not show is not joined for it.
    """
    load = lineage(load_dt, load_src)
    t: dict[str, DataFrame] = {}
    whole = lines if rows is None else rows
    of = lambda *parts: lines if {"product", "category"} & {*parts} else whole
    for name, business in BUSINESS_KEY.items():
        carried = ["order_dt"] if name == "order" else []
        stage = of(name).select(business, *carried)
        t[f"h_{name}"] = hub(stage if rows is None else stage.distinct(), f"h_{name}_pk", business, carried, load)
    for name in LINKS:
        parents = {f"h_{part}_pk": BUSINESS_KEY[part] for part in name.split("_")}
        t[f"l_{name}"] = link(of(*name.split("_")), f"hk_{name}_pk", parents, load)
    for name, (owner, payload) in SATELLITES.items():
        stage = of(owner).select(BUSINESS_KEY[owner], *[F.col(old).alias(new) for old, new in payload.items()])
        t[f"s_{name}"] = satellite(
            stage, {f"h_{owner}_pk": BUSINESS_KEY[owner]}, list(payload.values()), load, own_key=f"hk_{name}_pk")
    return t


def primary_key(table: str) -> str:
    """Key column of a vault table, from its name."""
    kind, name = table.split("_", 1)
    return f"h_{name}_pk" if kind == "h" else f"hk_{name}_pk"


def counter_messages(lines: DataFrame) -> DataFrame:
    """One row per product of each order, as the counters need it."""
    return lines.where("product_id is not null").select(
        uuid3("user_id").alias("user_id"), uuid3("product_id").alias("product_id"), "product_name",
        uuid3("category_name").alias("category_id"), "category_name", uuid3("order_id").alias("order_id"))


def counted_triples(lines: DataFrame, by: str) -> tuple[DataFrame, list[str]]:
    """What a counter counts once: (user, ``product`` or ``category``, order), and the key columns."""
    keys = ["user_id", BUSINESS_KEY[by], "order_id"]
    rest = [c for c in [f"{by}_name"] if c not in keys]
    return lines.where(F.col("product_id").isNotNull()).select(*keys, *rest), keys


def counter_deltas(triples: DataFrame, by: str) -> DataFrame:
    """Counts of triples that are new."""
    business, name = BUSINESS_KEY[by], f"{by}_name"
    names = [] if business == name else [F.min(name).alias(name)]
    return triples.groupBy("user_id", business).agg(F.count(F.lit(1)).alias("order_cnt"), *names)


def summed_counters(deltas: DataFrame, by: str) -> DataFrame:
    """The counters from the deltas of all batches."""
    business, name = BUSINESS_KEY[by], f"{by}_name"
    names = [] if business == name else [F.min(name).alias(name)]
    total = deltas.groupBy("user_id", business).agg(F.sum("order_cnt").alias("order_cnt"), *names)
    return total.select(
        uuid3("user_id").alias("user_id"), uuid3(business).alias(f"{by}_id"), name, "order_cnt")


def order_counters(lines: DataFrame, by: str) -> DataFrame:
    """Distinct orders per user and ``product`` or ``category``.

    Counted on the business keys; only the counters are hashed.
    """
    business, name = BUSINESS_KEY[by], f"{by}_name"
    names = [] if business == name else [F.min(name).alias(name)]
    counted = lines.where(F.col("product_id").isNotNull()).groupBy("user_id", business).agg(
        F.count_distinct("order_id").alias("order_cnt"), *names)
    return counted.select(
        uuid3("user_id").alias("user_id"), uuid3(business).alias(f"{by}_id"), name, "order_cnt")
