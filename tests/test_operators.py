"""Operators on small made fixtures, against plain Python or a plain window."""

import random
import uuid
from datetime import datetime, timedelta
from math import asin, cos, radians, sin, sqrt

import numpy as np
import pandas as pd
import pytest
from helpers import values
from pyspark.sql import Window, functions as F

from martloom.functions.geo import haversine_km, local_time, position_km
from martloom.functions.keys import known_uuid3, uuid3
from martloom.functions.text import address_parts
from martloom.operators import state as load_state
from martloom.operators.joins import orphans, salted_join, with_placeholders
from martloom.operators.nearest import nearest_zone, nearest_zones
from martloom.operators.ordered import (
    changes, hourly, with_last_known, with_neighbour, with_position)
from martloom.operators.pairs import LEAF, _crowded_pairs, channel_pairs, never_contacted
from martloom.operators.writes import (
    additive_upsert, first_per_key, insert_if_absent, new_rows, upsert_last_wins, versioned)


def km(lat1, lng1, lat2, lng2):
    p1, p2 = radians(lat1), radians(lat2)
    h = sin((p2 - p1) / 2) ** 2 + cos(p1) * cos(p2) * sin(radians(lng2 - lng1) / 2) ** 2
    return 2 * 6371 * asin(sqrt(min(1.0, h)))


# --- functions ---------------------------------------------------------------------

def test_uuid3_equals_python(spark):
    texts = ["", "abc", "Курьер", "17", "a|b", "x" * 300]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.k, r.n) for r in df.select("t", uuid3("t").alias("k"), known_uuid3("t").alias("n")).collect()}
    assert got == {t: (str(uuid.uuid3(uuid.NAMESPACE_OID, t)),) * 2 for t in texts}
    assert df.select(uuid3(F.lit(None))).first()[0] is None


def test_address(spark):
    df = spark.createDataFrame([("Main street, 5, apt 12",), ("Broken",), ("A, x, apt y",)], "a string")
    got = [tuple(r) for r in df.select(*address_parts(F.col("a")).values()).collect()]
    assert got == [("Main street", 5, 12), ("Broken", None, None), ("A", None, None)]


def test_local_time_converts_the_whole_timestamp(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 20:00:00' as ts, 'Australia/Sydney' as tz")
    assert df.select(local_time(F.col("ts"), F.col("tz"))).first()[0] == datetime(2024, 1, 2, 7)


def test_same_place_is_zero_km(spark):
    df = spark.sql("select 10.0D as a, 20.0D as b")
    assert df.select(haversine_km("a", "b", "a", "b")).first()[0] == 0.0


# --- ordered operations ----------------------------------------------------------------

@pytest.fixture(scope="module")
def log(spark):
    """Few keys, one of them with most rows, over days with gaps and equal times."""
    rng, start = random.Random(7), datetime(2024, 1, 1)
    rows = []
    for n in range(600):
        key = 1 if rng.random() < 0.7 else rng.randint(2, 6)
        at = start + timedelta(minutes=rng.randint(0, 6000))
        rows.append((key, at, n, rng.choice("ab"), rng.choice([None, n])))
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, id int, v string, x int")


ORDER = ["ts", "id"]


def test_neighbours_equal_plain_windows(log):
    w = Window.partitionBy("k").orderBy(*ORDER)
    for following, shift in ((False, F.lag), (True, F.lead)):
        got = with_neighbour(log, ["k"], ORDER, {"v": "near", "id": "near_id"}, hourly(F.col("ts")), following)
        want = log.withColumn("near", shift("v").over(w)).withColumn("near_id", shift("id").over(w))
        assert values(got, "id", "near", "near_id") == values(want, "id", "near", "near_id")


def test_versions_join_nothing_back(spark):
    """What crosses a slice border is never joined to the rows: Spark would guess its size and may broadcast all of it."""
    rows = spark.sql(
        "select cast(id % 7 as string) as k, id % 3 as v, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id) as at"
        " from range(100)")
    plan = versioned(rows, ["k"], ["v"], "at")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    lost = rows.selectExpr("if(k = '3', null, k) as k", "v", "at")
    near = with_neighbour(lost, ["k"], ["at"], {"v": "before"}, F.to_date("at")).where("k is null")
    assert near.where("before is not null").count() == 0  # a row without a key meets no other slice


def test_neighbours_of_few_rows_a_slice(spark, log):
    """``few`` gives the same values, with slices of one row, of many rows and unknown ones, and computes its input once."""
    odd = log.withColumn("k", F.expr("if(k = 6, null, k)")).withColumn("ts", F.expr("if(id % 50 = 0, null, ts)"))
    for slices in (F.col("ts"), hourly(F.col("ts"))):
        for following in (False, True):
            one, two = (
                with_neighbour(odd, ["k"], ORDER, {"v": "near", "id": "near_id"}, slices, following, few=few)
                for few in (False, True))
            assert values(one, "id", "k", "near", "near_id") == values(two, "id", "k", "near", "near_id")
    w = Window.partitionBy("k").orderBy(*ORDER)
    got = with_neighbour(log, ["k"], ORDER, {"id": "near"}, F.to_date("ts"), few=True)
    assert values(got, "id", "near") == values(log.withColumn("near", F.lag("id").over(w)), "id", "near")
    plan = versioned(log, ["k"], ["v"], "ts")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_last_known_equals_plain_window(log):
    w = Window.partitionBy("k").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    got = with_last_known(log, ["k"], ORDER, "x", hourly(F.col("ts")), "known")
    want = log.withColumn("known", F.last("x", ignorenulls=True).over(w))
    assert values(got, "id", "known") == values(want, "id", "known")


def test_position_equals_row_number(log):
    w = Window.partitionBy("k").orderBy(*ORDER)
    got = with_position(log, ["k"], ORDER, hourly(F.col("ts")), "n")
    assert values(got, "id", "n") == values(log.withColumn("n", F.row_number().over(w)), "id", "n")


def test_changes_equal_plain_window(log):
    w = Window.partitionBy("k").orderBy(*ORDER)
    want = log.withColumn("b", F.lag("v").over(w)).where("b is null or b <> v")
    assert values(changes(log, ["k"], ORDER, "v", hourly(F.col("ts"))), "id") == values(want, "id")


# --- nearest zone ---------------------------------------------------------------------------

def test_nearest_zone_equals_brute_force(spark):
    rng = random.Random(3)
    zones = [(n, rng.uniform(-85, 85), rng.uniform(-180, 180)) for n in range(60)]
    zones += [(100 + n, -33 + rng.random(), 151 + rng.random()) for n in range(40)]
    points = [(n, rng.uniform(-90, 90), rng.uniform(-180, 180)) for n in range(120)]
    points += [(1000 + n, -33 + rng.random(), 151 + rng.random()) for n in range(120)]
    points += [(5000, None, 1.0), (5001, 89.9, 0.0), (5002, 0.0, 180.0), (5003, 0.0, -180.0)]
    zone_df = spark.createDataFrame([(*z, f"c{z[0]}") for z in zones], "zone_id int, lat double, lng double, city string")
    point_df = spark.createDataFrame(points, "id int, lat double, lng double")
    want = {
        p[0]: min((km(p[1], p[2], z[1], z[2]), z[0]) for z in zones)[1] if p[1] is not None else None for p in points}
    for bound in (1000, 0):
        got = {r.id: r for r in nearest_zone(point_df, zone_df, max_array_zones=bound).collect()}
        assert {i: r.zone_id for i, r in got.items()} == want
        assert all(r.city == f"c{r.zone_id}" for r in got.values() if r.zone_id is not None)


def test_nearest_zone_tie_and_zero(spark):
    zones = spark.createDataFrame([(7, 10.0, 20.0), (3, 10.0, 20.0), (9, 11.0, 20.0)], "zone_id int, lat double, lng double")
    points = spark.createDataFrame([(1, 10.0, 20.0)], "id int, lat double, lng double")
    for bound in (10, 0):
        row = nearest_zone(points, zones, max_array_zones=bound).first()
        assert (row.zone_id, row.distance_km) == (3, 0.0)


# --- pairs ------------------------------------------------------------------------------------

def test_nearest_zones_of_a_long_list(spark):
    """Three nearest of 50,000 zones, half of them crowded at one city, equal brute force."""
    pick = np.random.default_rng(3)
    lat = np.r_[pick.uniform(-85, 85, 25_000), 55.7 + pick.normal(0, 0.1, 25_000)]
    lng = np.r_[pick.uniform(-180, 180, 25_000), 37.6 + pick.normal(0, 0.1, 25_000)]
    zones = spark.createDataFrame(pd.DataFrame({"zone_id": range(50_000), "lat": lat, "lng": lng}))
    at = [(55.7, 37.6), (55.7, 37.6), (56.9, 37.6), (-89.0, 10.0), (10.0, 179.99), (40.0, -100.0)]
    points = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(at)] + [(99, None, None)], "id int, lat double, lng double")
    got = {}
    for r in nearest_zones(points, zones, 3).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.zone_id
    for i, (plat, plng) in enumerate(at):
        p1, p2 = np.radians(plat), np.radians(lat)
        half = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lng - plng) / 2) ** 2
        assert [got[i][k] for k in (1, 2, 3)] == list(np.argsort(half, kind="stable")[:3])
    assert set(got) == set(range(len(at)))


def test_nearest_zones_fewer_than_asked(spark):
    zones = spark.createDataFrame([(2, 0.0, 0.0), (1, 0.0, 0.0), (3, None, 0.0)], "zone_id int, lat double, lng double")
    points = spark.createDataFrame([(1, 0.0, 1.0)], "id int, lat double, lng double")
    assert [(r["rank"], r.zone_id) for r in nearest_zones(points, zones, 3).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert nearest_zones(points, zones.limit(0), 3).count() == 0


# --- pairs ------------------------------------------------------------------------------------

def flat_pairs(lat, lng, within_km):
    """Index pairs within a distance, with each point against the rest."""
    found = set()
    for i in range(len(lat)):
        p1, p2 = np.radians(lat[i]), np.radians(lat[i + 1:])
        half = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lng[i + 1:] - lng[i]) / 2) ** 2
        found |= {(i, i + 1 + int(j)) for j in np.flatnonzero(2 * 6371 * np.arcsin(np.sqrt(half)) <= within_km)}
    return found


@pytest.mark.parametrize("leaf", [8, 64])
def test_crowded_cubes_equal_brute_force(spark, leaf):
    pick = np.random.default_rng(leaf)
    lat, lng = 50 + pick.normal(0, 0.02, 700), 30 + pick.normal(0, 0.02, 700)
    lat[:100], lng[:100] = 50.001, 30.001
    positions = spark.createDataFrame(pd.DataFrame({"user_id": range(700), "lat": lat, "lng": lng}))
    members = positions.select(F.lit("c").alias("channel"), "user_id")
    got = {(r.user_1, r.user_2) for r in channel_pairs(members, positions, 1.0, leaf).collect()}
    assert got == flat_pairs(lat, lng, 1.0)


def test_twenty_thousand_members_in_one_cube(spark):
    """The pairs of a dense cube come from many keys, and none of them holds more than a block meets."""
    pick = np.random.default_rng(1)
    side = np.degrees(1.8 / 6371)
    lat, lng = pick.uniform(0, side, 20_000), pick.uniform(0, side, 20_000)
    positions = spark.createDataFrame(pd.DataFrame({"user_id": range(20_000), "lat": lat, "lng": lng}))
    placed = positions.withColumns(position_km("lat", "lng")).select(F.lit("c").alias("channel"), "*")
    edge, reach = 2.0, 0.02
    cell = {f"c{a}": F.lit(0) for a in "xyz"}
    names = {"user_id": "user", "lat": "lat", "lng": "lng", "x": "x", "y": "y", "z": "z"}
    left, right = (placed.withColumnsRenamed({k: f"{v}_{n}" for k, v in names.items()}).withColumns(cell) for n in "12")
    near = _crowded_pairs(left, right, edge, reach, 256)
    sizes = near.groupBy(*LEAF, "block_1", "block_2").count()
    largest, tasks = sizes.agg(F.max("count"), F.count("*")).first()
    assert largest <= 4 * 256 ** 2 and tasks > 64
    found = near.where("user_1 < user_2").where(
        "pow(x_1 - x_2, 2) + pow(y_1 - y_2, 2) + pow(z_1 - z_2, 2) <= 0.0004")
    assert {tuple(r) for r in found.select("user_1", "user_2").collect()} == flat_pairs(lat, lng, 0.02)


def test_channel_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    users = {n: (-33 + rng.random() * 0.05, 151 + rng.random() * 0.05) for n in range(80)}
    users[80] = (None, None)
    joined = sorted({(1 if rng.random() < 0.5 else rng.randint(2, 5), rng.randint(0, 80)) for _ in range(200)})
    members = spark.createDataFrame(joined, "channel int, user_id int")
    positions = spark.createDataFrame([(u, *p) for u, p in users.items()], "user_id int, lat double, lng double")
    want = {
        (a, b) for c1, a in joined for c2, b in joined
        if c1 == c2 and a < b and None not in (*users[a], *users[b]) and km(*users[a], *users[b]) <= 1.0}
    pairs = channel_pairs(members, positions, 1.0)
    assert values(pairs, "user_1", "user_2") == sorted(want, key=str)
    assert len(want) > 20
    gone = sorted(want)[0]
    contacts = spark.createDataFrame([gone], "user_1 int, user_2 int")
    assert values(never_contacted(pairs, contacts), "user_1", "user_2") == sorted(want - {gone}, key=str)


def test_tasks_follow_the_number_of_pairs(spark):
    """A few members in one place give many pairs: these are made and brought together by many tasks."""
    positions = spark.range(120).selectExpr("id as user_id", "50.0D as lat", "30.0D as lng")
    members = positions.selectExpr("user_id % 2 as channel", "user_id").union(positions.selectExpr("7L", "user_id"))
    for leaf in (1_024, 16):
        pairs = channel_pairs(members, positions, 1.0, leaf, task_pairs=1_000)
        assert pairs.count() == 120 * 119 // 2
        assert pairs.rdd.getNumPartitions() >= 20 and channel_pairs(members, positions, 1.0, leaf).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("km_apart, expected", [(0.99, 1), (1.01, 0)])
def test_friend_distance_edge(spark, km_apart, expected):
    members = spark.createDataFrame([(1, 1), (1, 2)], "channel int, user_id int")
    degrees = km_apart / 6371 * 180 / 3.141592653589793
    positions = spark.createDataFrame([(1, 0.0, 0.0), (2, degrees, 0.0)], "user_id int, lat double, lng double")
    assert channel_pairs(members, positions, 1.0).count() == expected


# --- joins ---------------------------------------------------------------------------------------

def test_salted_join_equals_join(spark):
    many = spark.range(1000).selectExpr("id", "if(id % 3 > 0, 1, id % 7) as k")
    few = spark.createDataFrame([(1, "a"), (1, "b"), (4, "c")], "k long, v string")
    got = salted_join(many, few, ["k"], ["id"], 8)
    assert values(got, "id", "k", "v") == values(many.join(few, "k"), "id", "k", "v")


def test_placeholders_and_orphans(spark):
    dim = spark.createDataFrame([("1", "Ann")], "courier_id string, name string")
    facts = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "courier_id string")
    assert values(orphans(facts, {"courier_id": dim})) == [("courier_id", "2")]
    full = with_placeholders(dim, facts, "courier_id", {"name": F.lit("?")})
    assert values(full) == [("1", "Ann"), ("2", "?")]
    # The real row replaces its placeholder.
    real = spark.createDataFrame([("2", "Bob", 1)], "courier_id string, name string, v int")
    assert values(upsert_last_wins(full.withColumn("v", F.lit(0)), real, ["courier_id"], ["v"]), "courier_id", "name") == [
        ("1", "Ann"), ("2", "Bob")]


# --- write semantics -------------------------------------------------------------------------------

KV = "k int, v string, n int"


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old", 0)], KV)
    source = spark.createDataFrame([(1, "new", 1), (2, "b", 2), (2, "a", 1), (None, "x", 1)], KV)
    once = insert_if_absent(target, source, ["k"], [F.col("n")])
    assert values(once) == [(1, "old", 0), (2, "a", 1)]
    assert new_rows(once, source, ["k"], [F.col("n")]).count() == 0


def test_upsert_last_wins_in_any_arrival_order(spark):
    target = spark.createDataFrame([(1, "t", 5), (3, "tie", 1)], KV)
    source = spark.createDataFrame([(1, "late", 4), (2, "a", 1), (2, "b", 2), (3, "src", 1)], KV)
    assert values(upsert_last_wins(target, source, ["k"], ["n"])) == [(1, "t", 5), (2, "b", 2), (3, "src", 1)]


def test_additive_upsert(spark):
    target = spark.createDataFrame([(1, "a", 5)], KV)
    source = spark.createDataFrame([(1, "a", 2), (2, "b", 1)], KV)
    out = additive_upsert(target, source, ["k"], ["n"])
    assert values(out) == [(1, "a", 7), (2, "b", 1)]
    assert out.schema == target.schema


def test_versions_close_and_repeat_nothing(spark):
    rows = [(1, 10, "2024-01-01"), (1, 10, "2024-02-01"), (1, 12, "2024-03-01"), (1, None, "2024-04-01"), (2, 5, "2024-01-01")]
    df = spark.createDataFrame(rows, "k int, price int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = versioned(df, ["k"], ["price"], "at").select(
        "k", "price", F.to_date("active_from").cast("string"), F.to_date("active_to").cast("string"))
    assert values(got) == sorted([
        (1, 10, "2024-01-01", "2024-03-01"), (1, 12, "2024-03-01", "2024-04-01"),
        (1, None, "2024-04-01", "2099-12-31"), (2, 5, "2024-01-01", "2099-12-31")], key=str)


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as v")
    plan = first_per_key(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.index("row_number(), 1, Partial") > shuffle  # below the shuffle in the tree


def test_load_state(spark):
    batch = spark.createDataFrame([(3,), (9,)], "id int")
    state = load_state.empty(spark)
    assert load_state.read(state, "stg", "s", "t") is None
    state = load_state.advance(state, load_state.progress(batch, "stg", "s", "t", F.col("id"), 1))
    state = load_state.advance(state, load_state.progress(batch.where("id > 100"), "stg", "s", "t", F.col("id"), 2))
    assert load_state.read(state, "stg", "s", "t") == "9"
