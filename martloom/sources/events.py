"""Event log and zone list of the geo marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.functions.geo import decimal_comma

# Cities and the state capital whose time zone they share.
CAPITAL_OF = {
    "Rockhampton": "Brisbane",
    "Mackay": "Brisbane",
    "Gold Coast": "Brisbane",
    "Townsville": "Brisbane",
    "Ipswich": "Brisbane",
    "Cairns": "Brisbane",
    "Toowoomba": "Brisbane",
    "Wollongong": "Sydney",
    "Newcastle": "Sydney",
    "Maitland": "Sydney",
    "Cranbourne": "Melbourne",
    "Geelong": "Melbourne",
    "Ballarat": "Melbourne",
    "Bendigo": "Melbourne",
    "Launceston": "Hobart",
    "Bunbury": "Perth",
}
# Cities that name a time zone themselves.
ZONE_CITIES = ["Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide", "Hobart", "Darwin", "Canberra"]
DEFAULT_ZONE_CITY = "Sydney"


def scan_events(spark: SparkSession, location: str, event_type: str | None = None) -> DataFrame:
    """Event log with the union of all file schemas, optionally of one type.

    The log is partitioned by ``event_type``, so the type prunes folders.
    """
    events = spark.read.option("mergeSchema", "true").parquet(location)
    if event_type is None:
        return events
    wanted = events.where(F.col("event_type") == event_type)
    return wanted.where("event.message_id is not null") if event_type == "message" else wanted


def with_event_id(events: DataFrame) -> DataFrame:
    """Give events without ``event_id`` one made of their content; it orders events of equal time."""
    if "event_id" in events.columns:
        return events
    return events.withColumn("event_id", F.xxhash64(F.to_json("event"), "event_type", "lat", "lon"))


def timezone_of(city: Column) -> Column:
    """``Australia/<city>``; small cities use their capital, unknown ones the default."""
    capital = F.create_map(*[F.lit(x) for pair in CAPITAL_OF.items() for x in pair])
    own = F.when(city.isin(ZONE_CITIES), city)
    return F.concat(F.lit("Australia/"), F.coalesce(own, capital[city], F.lit(DEFAULT_ZONE_CITY)))


def geo_dimension(raw: DataFrame) -> DataFrame:
    """Zones with numeric coordinates and a time zone."""
    return raw.select(
        F.col("id").alias("zone_id"),
        "city",
        decimal_comma("lat").alias("lat"),
        decimal_comma("lng").alias("lng"),
        timezone_of(F.col("city")).alias("timezone"),
    )


def flatten_events(events: DataFrame) -> DataFrame:
    """Actor, time and kind of each event; the log fills one of two fields for each."""
    return events.select(
        "event_id",
        F.col("event.message_id").alias("message_id"),
        F.coalesce("event.message_from", "event.user").alias("user_id"),
        F.to_timestamp_ntz(F.coalesce("event.message_ts", "event.datetime")).alias("ts"),
        F.col("event.reaction_type").alias("reaction"),
        F.coalesce(F.col("event.subscription_channel").cast("string"), "event.subscription_user").alias("subs"),
        F.col("lat").alias("m_lat"),
        F.col("lon").alias("m_lng"),
    )
