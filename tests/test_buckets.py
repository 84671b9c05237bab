"""Bucket tables, the key index and the product history that increments maintain."""

import json
from datetime import datetime
from decimal import Decimal

from helpers import values
from pyspark.sql import functions as F

from martloom.bindings import AS_OF, Inputs
from martloom.operators.writes import upsert_last_wins
from martloom.plans import jobs, settlement
from martloom.session import stored
from martloom.sources import buckets, tables

SF_DIR = "/root/testdata/sf0.001"


def by_bucket(table):
    """Files of every bucket, from the folders the manifest names."""
    found = {}
    for file in table.read().inputFiles():
        run, bucket = file.split("/")[-3:-1]
        found.setdefault(int(bucket.split("=")[1]), set()).add((run, file))
    return found


def test_first_batch_is_compared_with_nothing(spark, tmp_path, monkeypatch):
    """No join and no copy before there are stored keys, also when the first batch is repeated."""
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    with monkeypatch.context() as only:
        only.delattr(buckets, "known_keys")
        only.delattr(buckets, "stored")
        for _ in range(2):
            buckets.append_new(rows, str(tmp_path), ["k"], 4)
    buckets.append_new(rows.union(rows.selectExpr("concat(k, 'x')", "v")), str(tmp_path), ["k"], 5)
    assert values(spark.read.parquet(str(tmp_path)), "k", "v", "batch_id") == [
        ("a", 1, 4), ("ax", 1, 5), ("b", 2, 4), ("bx", 2, 5)]


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    table = buckets.BucketTable(spark, str(tmp_path), ["k"], "k string, v int, at int", buckets=8)
    assert not table.exists() and table.read().count() == 0
    first = spark.createDataFrame([(f"k{n}", n, 1) for n in range(100)], "k string, v int, at int")
    assert buckets.upsert(table, first, lambda old, new: old.unionByName(new)) == list(range(8))
    before = by_bucket(table)
    change = spark.createDataFrame([("k3", -3, 2), ("k3", -4, 0)], "k string, v int, at int")
    touched = buckets.upsert(table, change, lambda old, new: upsert_last_wins(old, new, ["k"], ["at"]))
    after = by_bucket(table)
    assert len(touched) == 1 and {b for b in after if after[b] != before.get(b)} == set(touched)
    assert values(table.read().where("v < 0")) == [("k3", -3, 2)] and table.read().count() == 100
    # A writer that died before its manifest is not seen, and its folder goes when old runs are retired.
    table._write(first.where("false or k = 'k5'").withColumn("v", F.lit(999)), "rewrite-99")
    assert table.read().where("v = 999").count() == 0
    # The first run still holds seven buckets; only what nothing names goes.
    assert table.retire() == 1 and table.read().count() == 100
    # A bucket that has lost all rows is empty.
    table.replace(first.limit(0), touched)
    assert table.read(touched).count() == 0 and table.read().count() < 100
    assert buckets.upsert(table, first.limit(0), lambda old, new: old) == []


def test_appended_segments_are_written_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "SEGMENTS", 2)
    table = buckets.BucketTable(spark, str(tmp_path), ["k"], "k int, b int", buckets=2)
    for batch in range(buckets.SEGMENTS + 3):
        table.append(spark.createDataFrame([(batch, batch), (batch + 100, batch)], "k int, b int"), batch)
    table.append(spark.createDataFrame([(7777, 1)], "k int, b int"), batch)
    counts = {}
    for b, _ in table.segments():
        counts[b] = counts.get(b, 0) + 1
    assert max(counts.values()) <= buckets.SEGMENTS + 1
    # The last batch was repeated with other rows and holds only those.
    want = [(k, k) for k in range(batch)] + [(k + 100, k) for k in range(batch)] + [(7777, 1)]
    assert values(table.read()) == sorted(want, key=str)


def test_append_new_reads_only_touched_buckets(spark, tmp_path):
    where = f"{tmp_path}/t"
    big = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    buckets.append_new(big, where, ["k"], 0)
    index = buckets.BucketTable(spark, f"{where}/_keys", ["k"], "k string, batch_id int", buckets.KEY_BUCKETS)
    batch = stored(spark.createDataFrame([("5", 2), ("new", 2), (None, 2), ("new", 2)], "k string, v int"), "batch")
    known = buckets.known_keys(index, batch.dropna(), 1)
    # Two keys, two buckets of 16; the stored keys are not shuffled.
    assert len({f.split("__bucket=")[1].split("/")[0] for f in known.inputFiles() if "__bucket=" in f}) == 2
    assert values(known) == [("5",)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    stored_side = plan[plan.index("BroadcastHashJoin"):]
    assert "BroadcastExchange" in stored_side and "Exchange hashpartitioning" not in stored_side.split("BroadcastExchange")[0]
    for _ in range(2):
        buckets.append_new(batch, where, ["k"], 1)
        assert values(spark.read.parquet(where).where("batch_id = 1")) == [("new", 2, 1)]
    # The batch comes again with another key: the key it no longer brings is free again.
    buckets.append_new(spark.createDataFrame([("other", 3)], "k string, v int"), where, ["k"], 1)
    buckets.append_new(spark.createDataFrame([("new", 4), ("other", 4)], "k string, v int"), where, ["k"], 2)
    assert values(spark.read.parquet(where).where("batch_id > 0")) == [("new", 4, 2), ("other", 3, 1)]


def test_append_new_to_a_table_without_index(spark, tmp_path):
    where = str(tmp_path)
    tables.append_batch(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), where, 0)
    buckets.append_new(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), where, ["k"], 1)
    assert values(spark.read.parquet(where)) == [("a", 1, 0), ("b", 1, 0), ("c", 2, 1)]


def menu(restaurant, at, *items):
    text = json.dumps({"name": f"Place {restaurant}", "menu": [
        {"_id": {"$oid": i}, "name": n, "price": p} for i, n, p in items]})
    return restaurant, text, at


def test_history_by_increments_equals_the_whole_log(spark, tmp_path):
    day = lambda n: datetime(2024, 1, n)
    log = [
        menu("r1", day(1), ("p1", "Tea", 10), ("p2", "Cake", 5)), menu("r1", day(9), ("p1", "Tea", 12)),
        menu("r2", day(2), ("p1", "Tea", 10)), menu("r1", day(20), ("p1", "Tea", 12), ("p2", "Cake", 5)),
        # Late: between two versions; before the first; equal to its neighbour; inside a run of equal ones, so that
        # what the document of day 20 stated becomes a version again.
        menu("r1", day(5), ("p1", "Tea", 11)), menu("r2", day(1), ("p1", "Tea", 9)),
        menu("r1", day(10), ("p1", "Tea", 12)), menu("r1", day(15), ("p1", "Tea", 13), ("p2", "Cake", 6)),
        # Two documents of one moment: the greater payload counts.
        menu("r2", day(2), ("p1", "Tea", 8))]
    schema = "object_id string, object_value string, update_ts timestamp_ntz"
    loads = [log[:4], log[4:6], log[6:], log[2:3], []]
    for k, load in enumerate(loads):
        got = jobs.update_products(spark.createDataFrame(load, schema), str(tmp_path))
        seen = spark.createDataFrame([d for part in loads[:k + 1] for d in part], schema)
        assert values(got, *settlement.dim_products(seen).columns) == values(settlement.dim_products(seen))
        names = jobs.update_restaurants(spark.createDataFrame(load, schema), str(tmp_path))
        want = settlement.dim_restaurants(seen)
        assert values(names, *want.columns) == values(want)
    tea = got.where("restaurant_id = 'r1' and product_id = 'p1'").orderBy("active_from").select("product_price").collect()
    assert [r[0] for r in tea] == [Decimal(n) for n in (10, 11, 12, 13, 12)]


def test_documents_keep_their_log_and_facts_their_versions(spark, tmp_path):
    """Loads chained to the settlement job; the second brings an older menu, the facts still find their versions."""
    inputs, out = Inputs(spark, SF_DIR), str(tmp_path)
    log = inputs.restaurant_documents
    newer, older = log.where("update_ts >= '2022-02-01'"), log.where("update_ts < '2022-02-01'")
    for run, part in ((1, newer), (2, older)):
        part.write.json(f"{out}/landing{run}")
        # A landing zone of its own, so that the stored time does not hide the late documents.
        jobs.load_documents(spark, f"{out}/landing{run}", f"{out}/stg{run}", "restaurants", run)
        new = jobs.loaded_run(spark, f"{out}/stg{run}", "restaurants", run)
        jobs.settlement_job(inputs.user_documents, new, inputs.order_documents, inputs.outbox, f"{out}/dds", AS_OF)
        products = jobs.product_tables(spark, f"{out}/dds", settlement.menu_items(log))[1].read()
        fact = spark.read.parquet(f"{out}/dds/fct_product_sales")
        assert fact.join(products.select(F.col("id").alias("product_id")), "product_id").count() == fact.count() > 0
    want = settlement.dim_products(log)
    assert values(products, *want.columns) == values(want)


def test_loading_documents_rewrites_touched_buckets(spark, tmp_path):
    out, schema = str(tmp_path), jobs.DOCUMENT
    rows = [(f"d{n}", "{}", datetime(2024, 1, 1)) for n in range(200)]
    spark.createDataFrame(rows, schema).write.json(f"{out}/in1")
    jobs.load_documents(spark, f"{out}/in1", out, "docs", 1)
    table = buckets.BucketTable(spark, f"{out}/docs", ["object_id"], schema)
    before = by_bucket(table)
    changed = [("d7", "{\"v\": 2}", datetime(2024, 1, 3)), ("d7", "{\"v\": 1}", datetime(2024, 1, 2)), ("d8", "{}", datetime(2023, 1, 1))]
    spark.createDataFrame(changed, schema).write.json(f"{out}/in2")
    loaded = jobs.load_documents(spark, f"{out}/in2", out, "docs", 2)
    assert loaded.count() == 200 and values(loaded.where("object_id = 'd7'"), "object_value") == [("{\"v\": 2}",)]
    assert sum(by_bucket(table)[b] != before[b] for b in before) == 1
    assert jobs.loaded_run(spark, out, "docs", 2).count() == 2


def test_work_folders_go_after_an_error_too(spark):
    from martloom.session import work_folders_removed
    held = []
    try:
        with work_folders_removed(spark):
            held.append(stored(spark.range(3), "left").inputFiles()[0])
            raise RuntimeError
    except RuntimeError:
        pass
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(held[0])
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
