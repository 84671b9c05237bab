"""Campaign notifications: stream of offers joined to subscribers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from martloom import schemas
from martloom.functions.text import json_rejects, with_parsed
from martloom.operators.joins import salted_join
from martloom.operators.writes import first_per_key
from martloom.sources.buckets import BucketTable
from martloom.streaming.flow import Sink

OUT_COLUMNS = [
    "client_id", "restaurant_id", "adv_campaign_id", "adv_campaign_content", "adv_campaign_owner",
    "adv_campaign_owner_contact", "adv_campaign_datetime_start", "adv_campaign_datetime_end",
    "datetime_created", "trigger_datetime_created"]
CAMPAIGN_KEY = ["restaurant_id", "adv_campaign_id"]


def parse_campaigns(messages: DataFrame) -> DataFrame:
    """Broker messages to campaign columns; a message that is not valid JSON gives NULLs."""
    texts = messages.withColumn("value", F.col("value").cast("string")).withColumnRenamed(
        "timestamp", "org_timestamp")
    return with_parsed(texts, "value", schemas.CAMPAIGN)


def campaign_rejects(messages: DataFrame) -> DataFrame:
    """Message texts that announce no campaign, with the ``reason``."""
    required = [*CAMPAIGN_KEY, "adv_campaign_datetime_start", "adv_campaign_datetime_end"]
    texts = messages.select(F.col("value").cast("string").alias("value"))
    return json_rejects(texts, "value", schemas.CAMPAIGN, required)


def active_campaigns(campaigns: DataFrame, now: int | None = None) -> DataFrame:
    """Campaigns running at ``now`` (epoch seconds); by default the time of each micro-batch."""
    at: Column = F.unix_timestamp(F.current_timestamp()) if now is None else F.lit(now).cast("long")
    return campaigns.withColumn("trigger_datetime_created", at).where(
        "adv_campaign_datetime_start < trigger_datetime_created"
        " and adv_campaign_datetime_end > trigger_datetime_created")


def first_offers(active: DataFrame, delay: str = "1 day") -> DataFrame:
    """One message per restaurant and campaign; the state of a key expires after ``delay``."""
    return active.withWatermark("org_timestamp", delay).dropDuplicatesWithinWatermark(CAMPAIGN_KEY)


def static_subscribers(subscribers: DataFrame) -> DataFrame:
    """One row per client and restaurant, the one with the smallest id."""
    known = subscribers.where("client_id is not null and restaurant_id is not null")
    return first_per_key(known, ["client_id", "restaurant_id"], [F.col("id")])


def campaign_push(
    messages: DataFrame, subscribers: DataFrame, now: int | None = None, delay: str = "1 day", salts: int = 16
) -> DataFrame:
    """Notifications for every subscriber of a restaurant with a running campaign.

    Filter first, then de-duplicate: an expired message cannot hide a valid
    one.  A restaurant with very many subscribers is spread over ``salts`` tasks.
    """
    return push_to(messages, static_subscribers(subscribers), now, delay, salts)


def push_to(
    messages: DataFrame, audience: DataFrame, now: int | None = None, delay: str = "1 day", salts: int = 16
) -> DataFrame:
    """``campaign_push`` for subscribers that hold one row per client and restaurant already."""
    offers = first_offers(active_campaigns(parse_campaigns(messages), now), delay)
    audience = audience.select("client_id", "restaurant_id")
    return salted_join(audience, offers, ["restaurant_id"], ["client_id"], salts).select(*OUT_COLUMNS)


def to_audience(audience: BucketTable, sink: Sink) -> Sink:
    """Offers of a micro-batch -> notifications of the restaurants' subscribers, for ``sink``.

    ``audience`` lies in hash buckets of ``restaurant_id``: a batch opens only the buckets of its restaurants.  The
    join is planned for each batch by its real sizes.  Few offers are broadcast, then the audience is not
    shuffled; else adaptive execution splits a restaurant with very many subscribers.
    """
    def write(offers: DataFrame, batch_id: int) -> None:
        offers.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = audience.read(audience.touched(offers)).select("client_id", "restaurant_id")
            sink(found.join(offers, "restaurant_id").select(*OUT_COLUMNS), batch_id)
        finally:
            offers.unpersist()
    return write
