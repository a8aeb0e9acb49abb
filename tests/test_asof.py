"""As-of join and insert-only loads on small rows."""

import random

import pytest
from pyspark.sql import functions as F

from tracelake.plans import tables
from tracelake.plans.asof import as_of_join


def _expected(events, states):
    out = []
    for k, t, e in events:
        found = [(st, sv) for sk, st, sv in states if sk is not None and sk == k and st is not None and t is not None and st <= t]
        out.append((k, t, e, max(found, key=lambda x: (x[0], x[1] is not None, x[1]))[1] if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [1, 4, 9])
def test_as_of_join_equals_brute_force(spark, buckets):
    rng = random.Random(buckets)
    keys = ["a", "b", "c", "only events", None]
    events = [(rng.choice(keys), rng.choice([*range(30), None]), rng.randrange(4)) for _ in range(300)]
    events += [("hot", t, 0) for t in range(200)] + [("hot", 17, 5)] * 100  # a third of the rows, and equal rows
    states = [(rng.choice(["a", "b", "only states", None]), rng.choice([*range(0, 30, 3), None]), f"s{i}") for i in range(60)]
    states += [("hot", t, f"h{t}") for t in (3, 60, 150)] + [("hot", 60, "h6"), ("hot", 61, None)]
    e = spark.createDataFrame(events, "k string, t int, e int")
    s = spark.createDataFrame(states, "k string, t int, v string")
    got = as_of_join(e, s, "k", "t", "k", "t", ["v"], buckets=buckets)
    assert got.columns == ["k", "t", "e", "v"]
    want = _expected(events, states)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert as_of_join(e.limit(0), s, "k", "t", "k", "t", ["v"]).count() == 0
    none = as_of_join(e, s.limit(0), "k", "t", "k", "t", ["v"])
    assert none.where(F.col("v").isNotNull()).count() == 0 and none.count() == len(events)


def test_as_of_join_splits_a_hot_key(spark):
    events = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    states = spark.range(50).select(F.lit(-1).alias("k"), (F.col("id") * 100).alias("t"), F.col("id").alias("v"))
    got = as_of_join(events, states, "k", "t", "k", "t", ["v"], buckets=8)
    rows = got.withColumn("p", F.spark_partition_id()).where("k = -1").groupBy("p").count().collect()
    assert len(rows) >= 3  # the hot key is in several tasks
    assert got.where("k = -1 AND v <> least(t div 100, 49)").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        as_of_join(events, states, "k", "t", "k", "t", ["t"])


PART = "part_id string, time_updated long, text string"


def test_insert_only_adds_what_no_load_holds(spark, scratch):
    path = scratch("inserts")
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), (None, 1, "n"), (None, None, None)], PART)
    assert tables.insert_only(path, first, 0) == 4
    # known keys, one new, a known and a new row without a key
    second = spark.createDataFrame([("a", 9, "new version"), ("c", 1, "w"), (None, 1, "n"), (None, 2, "n")], PART)
    assert tables.insert_only(path, second, 1) == 2
    assert tables.insert_only(path, second, 1) == 2  # the same load again replaces itself
    assert tables.insert_only(path, second, 2) == 0  # and under a new number adds nothing
    assert tables.insert_only(path, first, 3) == 0
    got = sorted((tuple(r) for r in tables.read_loads(spark, path).select("load_id", "part_id", "time_updated", "text").collect()), key=str)
    want = [(0, "a", 2, "y"), (0, "b", 1, "z"), (0, None, 1, "n"), (0, None, None, None), (1, "c", 1, "w"), (1, None, 2, "n")]
    assert got == sorted(want, key=str)
    # a load with a column that the stored ones lack
    wider = spark.createDataFrame([("d", 1, "v", "k"), (None, 1, "n", "k"), (None, 1, "n", None)], PART + ", kind string")
    assert tables.insert_only(path, wider, 4) == 2
    assert tables.insert_only(path, first.limit(0), 5) == 0


def test_insert_only_prunes_loads_and_filters_stored_keys(spark, scratch):
    path = scratch("inserts")
    for n in range(2):
        tables.insert_only(path, spark.range(n * 500, n * 500 + 500).selectExpr("'p' || id AS part_id", "id AS time_updated", "'x' AS text"), n)
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        new = scratch("new")
        spark.range(900, 1100).selectExpr("'p' || id AS part_id", "id AS time_updated", "'x' AS text").write.parquet(new)
        stored = tables.read_loads(spark, path).where("load_id <> 2")
        rows = tables.unseen(stored, spark.read.parquet(new))
        plan = rows._jdf.queryExecution().toString()
        assert rows.count() == 100
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan
    scans = [line for line in plan.split("== Physical Plan ==")[-1].splitlines() if "load_id" in line and "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(load_id" in line for line in scans)
    keys_only = [line for line in scans if "IsNotNull(part_id)" in line]
    assert keys_only and all("ReadSchema: struct<part_id:string>" in line for line in keys_only)
