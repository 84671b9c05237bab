"""User, zone and friend marts over the geo-tagged event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.functions.geo import local_time
from martloom.operators.nearest import nearest_zone
from martloom.operators.ordered import changes, hourly, with_last_known, with_neighbour, with_position
from martloom.operators.pairs import channel_members, channel_pairs, contact_pairs, never_contacted
from martloom.session import stored
from martloom.sources.events import flatten_events

IN_TIME = ["ts", "event_id"]
# Cities per travel_array; a user with more visits gets further pages.


def located_messages(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Messages with the zone they were sent from."""
    messages = events.where("event_type = 'message' and event.message_id is not null")
    return nearest_zone(flatten_events(messages), zones, "m_lat", "m_lng")


def last_known_location(events: DataFrame) -> DataFrame:
    """All events; those without own coordinates take the user's last message's."""
    flat = flatten_events(events).where("user_id is not null")
    own = F.when(F.col("m_lat").isNotNull() & F.col("m_lng").isNotNull(), F.struct("m_lat", "m_lng"))
    filled = with_last_known(
        flat.withColumn("__own", own), ["user_id"], IN_TIME, "__own", hourly(F.col("ts")), "__at")
    return filled.withColumns({"m_lat": F.col("__at.m_lat"), "m_lng": F.col("__at.m_lng")}).drop("__own", "__at")


def located_events(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Events of all types with a zone; an event before the user's first message has none and is left out."""
    known = last_known_location(events).where("m_lat is not null and m_lng is not null")
    return nearest_zone(known, zones, "m_lat", "m_lng")


def city_arrivals(located: DataFrame) -> DataFrame:
    """Messages sent from another city than the user's message before."""
    return changes(located, ["user_id"], IN_TIME, "city", hourly(F.col("ts"))).select(
        "user_id", "event_id", "city", "ts")


def city_stays(arrivals: DataFrame, located: DataFrame) -> DataFrame:
    """Arrivals with the days until the next one (or the end of the data)."""
    left = with_neighbour(
        arrivals, ["user_id"], IN_TIME, {"ts": "next_ts"}, hourly(F.col("ts")), following=True)
    end_of_data = located.agg(F.max("ts")).scalar()
    return left.withColumn("duration", F.datediff(F.coalesce(F.col("next_ts"), end_of_data), "ts"))


def home_city(stays: DataFrame, home_days: int = 27) -> DataFrame:
    """Last city with a stay of at least ``home_days``; without one, the city of the longest stay.

    Also the number of visits to cities, which falls out of the same aggregate.
    """
    per_city = stays.groupBy("user_id", "city").agg(
        F.max("duration").alias("longest"), F.max(F.struct(*IN_TIME)).alias("latest"),
        F.count(F.lit(1)).alias("visits"))
    long_stay = F.col("longest") >= home_days
    return (
        per_city.groupBy("user_id")
        .agg(F.max_by("city", F.when(long_stay, F.col("latest"))).alias("lived_in"),
             F.max_by("city", F.struct("longest", "latest")).alias("stayed_longest"),
             F.sum("visits").alias("travel_count"))
        .select("user_id", F.coalesce("lived_in", "stayed_longest").alias("home_city"), "travel_count"))


def travel_history(stays: DataFrame) -> DataFrame:
    """Stays numbered per user as ``visit_no``."""
    return with_position(stays, ["user_id"], IN_TIME, hourly(F.col("ts")), "visit_no")


def travel_lists(history: DataFrame) -> DataFrame:
    """Each user's visited cities in order, one row per user."""
    visits = F.array_sort(F.collect_list(F.struct("visit_no", "city")))
    return history.groupBy("user_id").agg(F.transform(visits, lambda v: v["city"]).alias("travel_array"))


def user_visits(events: DataFrame, zones: DataFrame) -> DataFrame:
    """The travel lists as rows (user_id, visit_no, city, ...): a user's history of any length."""
    located = stored(located_messages(events, zones).select("user_id", "event_id", "ts", "city"), "located_messages")
    return travel_history(city_stays(stored(city_arrivals(located), "city_arrivals"), located))


def actual_city(located: DataFrame) -> DataFrame:
    """City, zone and time of each user's last message."""
    last = F.max_by(F.struct("city", "timezone", "ts"), F.struct(*IN_TIME))
    return located.groupBy("user_id").agg(last.alias("last")).select(
        "user_id", F.col("last.city").alias("act_city"), F.col("last.timezone").alias("timezone"),
        F.col("last.ts").alias("ts"))


def user_geo_stats(events: DataFrame, zones: DataFrame, home_days: int = 27) -> DataFrame:
    """One row per user (and travel page): actual and home city, visits, local time.

    The located messages, the far fewer arrivals and the numbered stays are
    each computed once and stored, as several branches read them.
    """
    columns = ["user_id", "event_id", "ts", "city", "timezone"]
    located = stored(located_messages(events, zones).select(*columns), "located_messages")
    arrivals = stored(city_arrivals(located), "city_arrivals")
    history = stored(travel_history(city_stays(arrivals, located)), "travel_history")
    return (
        home_city(history, home_days)
        .join(actual_city(located), "user_id")
        .join(travel_lists(history), "user_id")
        .withColumn("local_time", local_time(F.col("ts"), F.col("timezone")))
        .select("user_id", "act_city", "home_city", "travel_count", "travel_array", "local_time"))


def user_zone_days(located: DataFrame) -> DataFrame:
    """Counts per user, zone and day, and the first event among them.

    The zone counts and the registrations both follow from this small table.
    """
    return located.groupBy("user_id", "zone_id", F.to_date("ts").alias("day")).agg(
        F.count("message_id").alias("message"), F.count("reaction").alias("reaction"),
        F.count("subs").alias("subscription"), F.min(F.struct(*IN_TIME)).alias("first"))


def registrations(user_days: DataFrame) -> DataFrame:
    """Each user's first event."""
    first = F.min(F.struct("first.ts", "first.event_id", "zone_id", "day"))
    return user_days.groupBy("user_id").agg(first.alias("first")).select("user_id", "first.*")


def zone_counts_daily(user_days: DataFrame) -> DataFrame:
    """Counts per zone and day, the basis of the weekly and monthly ones."""
    counts = user_days.groupBy("zone_id", "day").agg(
        *[F.sum(c).alias(c) for c in ("message", "reaction", "subscription")])
    new_users = registrations(user_days).groupBy("zone_id", "day").agg(F.count(F.lit(1)).alias("user"))
    return counts.join(new_users, ["zone_id", "day"], "left").fillna(0, ["user"])


def zone_counts(daily_counts: DataFrame, period: str) -> DataFrame:
    """Roll days up to ``week`` or ``month``."""
    start = F.date_trunc(period, F.col("day").cast("timestamp_ntz")).cast("timestamp_ntz")
    return daily_counts.groupBy("zone_id", start.alias(period)).agg(
        *[F.sum(c).alias(f"{period}_{c}") for c in ("message", "reaction", "subscription", "user")])


def zone_stats(events: DataFrame, zones: DataFrame) -> DataFrame:
    """Counts per zone, week and month; a week belongs to the month of its Monday.

    A month without a week of its own, and a week whose month has no counts
    itself, are rows with the other half NULL: no count is lost.
    """
    per_day = zone_counts_daily(stored(user_zone_days(located_events(events, zones)), "user_zone_days"))
    weeks = zone_counts(per_day, "week").withColumn(
        "month", F.date_trunc("month", "week").cast("timestamp_ntz"))
    return zone_counts(per_day, "month").join(weeks, ["zone_id", "month"], "full").select(
        "month", "week", "zone_id", "week_message", "week_reaction", "week_subscription", "week_user",
        "month_message", "month_reaction", "month_subscription", "month_user")


def final_coordinates(events: DataFrame) -> DataFrame:
    """Coordinates of each user's last located event, and the time of the last event of any kind."""
    flat = flatten_events(events).where("user_id is not null")
    both = F.col("m_lat").isNotNull() & F.col("m_lng").isNotNull()
    last = F.max_by(F.struct("m_lat", "m_lng"), F.when(both, F.struct(*IN_TIME)))
    return flat.groupBy("user_id").agg(last.alias("at"), F.max("ts").alias("ts")).select(
        "user_id", F.col("at.m_lat").alias("lat"), F.col("at.m_lng").alias("lng"), "ts")


def friend_recommendations(
    events: DataFrame, zones: DataFrame, processed_dttm, within_km: float = 1.0
) -> DataFrame:
    """Users who share a channel, never wrote to each other and are near; zone and time of the left one."""
    positions = stored(final_coordinates(events), "positions")
    pairs = never_contacted(
        channel_pairs(channel_members(events), positions, within_km), contact_pairs(events))
    homes = nearest_zone(positions, zones).select(
        F.col("user_id").alias("user_1"), "zone_id",
        local_time(F.col("ts"), F.col("timezone")).alias("local_time"))
    return pairs.join(homes, "user_1").select(
        F.col("user_1").alias("user_left"), F.col("user_2").alias("user_right"), "zone_id",
        F.lit(processed_dttm).cast("timestamp_ntz").alias("processed_dttm"), "local_time")
