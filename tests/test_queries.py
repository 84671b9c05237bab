"""Every registered query against its SQL twin, and its plan."""

import __spark_entry__ as entry
import pytest
from compare import compare, duck

from martloom.oracles import all_oracles
from martloom.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
# Queries whose result is empty on the smallest data.
MAY_BE_EMPTY = {"late_courier_members", "unmatched_keys", "pairs_never_contacted", "friend_recommendations"}
QUERIES, ORACLES = all_queries(), all_oracles()
STAGED = ("stream_", "order_chain", "campaign_push", "sink_")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", ["unmatched_keys", "courier_ledger", "courier_ledger_order_floor"])
def test_delivery_texts_are_parsed_once(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "l_orderkey" not in plan  # the texts are made and parsed before, once


def test_landed_texts_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("martloom.registry.work_dir", lambda _, name: f"{tmp_path}/{name}")
    QUERIES["api_incremental_landing"](spark, SF_DIR)
    landed = [f.suffix for f in tmp_path.glob("deliveries/landed/*/part-*")]
    assert landed and set(landed) == {".gz"}


@pytest.mark.parametrize("name, texts, batches", [
    ("stream_user_product_counters", "counters/in", {"counters/checkpoint_product": 3}),
    ("stream_restart_no_double", "restart/in", {"restart/checkpoint_category": 2}),
    ("order_chain_counters", "chain/in", {"chain/stg/checkpoint": 2}),
])
def test_messages_of_the_streams_are_compressed(spark, tmp_path, monkeypatch, name, texts, batches):
    monkeypatch.setattr("martloom.registry.work_dir", lambda _, folder: f"{tmp_path}/{folder}")
    QUERIES[name](spark, SF_DIR)
    written = [f for f in tmp_path.rglob("part-*") if f.suffix != ".parquet"]
    assert any(texts in str(f) for f in written) and {f.suffix for f in written} == {".gz"}
    for checkpoint, n in batches.items():
        assert sum(f.name.isdigit() for f in (tmp_path / checkpoint / "commits").iterdir()) == n


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    found = compare(df, con, ORACLES[name])
    if name in MAY_BE_EMPTY:
        found = [f for f in found if f != "empty"]
    assert not found


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
