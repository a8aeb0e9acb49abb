"""Stored tables on a scratch folder."""

from pyspark.sql import functions as F

from tracelake.plans import tables
from tracelake.schemas import PARTS
from tracelake.sources import sinks
from tracelake.sources.tables import list_parquet, read_parts

import pytest


def _versions(spark):
    rows = [("hot", t, f"v{t}") for t in range(300)] + [(f"k{i}", 1, "only") for i in range(50)]
    return spark.createDataFrame(rows, "part_id string, time_updated bigint, text string")


def test_latest_keeps_newest_even_for_a_hot_key(spark):
    out = {r["part_id"]: r for r in tables.latest(_versions(spark)).collect()}
    assert len(out) == 51 and out["hot"]["text"] == "v299" and out["k3"]["text"] == "only"
    plan = tables.latest(_versions(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # map-side combine before the shuffle


def test_upsert_as_of_history(spark, scratch):
    d = scratch("loads")
    base = spark.createDataFrame([("a", 1, "a1"), ("b", 1, "b1")], "part_id string, time_updated bigint, text string")
    tables.upsert(d, base, 0)
    tables.upsert(d, spark.createDataFrame([("a", 2, "a2"), ("c", 2, "c2")], base.schema), 1)
    now = {r["part_id"]: r["text"] for r in tables.as_of(spark, d).collect()}
    assert now == {"a": "a2", "b": "b1", "c": "c2"}
    then = {r["part_id"]: r["text"] for r in tables.as_of(spark, d, 0).collect()}
    assert then == {"a": "a1", "b": "b1"}
    hist = [(r["load_id"], r["operation"], r["rows"], r["inserts"], r["updates"])
            for r in tables.load_history(spark, d).collect()]
    assert hist == [(0, "append", 2, 2, 0), (1, "upsert", 2, 1, 1)]
    plan = tables.read_loads(spark, d).where(F.col("load_id") <= 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "load_id" in plan
    compacted = tables.compact(spark, d, scratch("compact"))
    assert tables.as_of(spark, compacted).count() == 3


def test_create_table_once_is_idempotent(spark, scratch):
    df = spark.range(10).withColumnRenamed("id", "x")
    n1 = tables.create_table_once(spark, "tl_test_db", "t", df, location=scratch("wh"))
    n2 = tables.create_table_once(spark, "tl_test_db", "t", spark.range(3).withColumnRenamed("id", "x"))
    assert n1 == n2 == 10
    assert [r["table"] for r in tables.list_tables(spark, "tl_test_db").collect()] == ["t"]
    assert tables.list_tables(spark, "no_such_db").count() == 0


def test_partitioned_write_prunes(spark, scratch):
    df = spark.createDataFrame([("p1", 1704067200000), ("p2", 1706745600000)], "part_id string, time_created bigint")
    path = tables.write_partitioned(df, scratch("by-month"))
    q = spark.read.parquet(path).where(F.col("month") == "2024-02")
    assert [r["part_id"] for r in q.collect()] == ["p2"]
    assert "PartitionFilters: [isnotnull(month" in q._jdf.queryExecution().executedPlan().toString()


def test_schema_evolution(spark, scratch):
    root = scratch("evolve")
    spark.createDataFrame([("p1", 5)], "part_id string, tokens_total int").write.parquet(f"{root}/old")
    spark.createDataFrame([("p2", 7, '["a"]')], "part_id string, tokens_total bigint, files string").write.parquet(f"{root}/new")
    rows = {r["part_id"]: r for r in tables.read_evolved(spark, [f"{root}/old", f"{root}/new"], PARTS).collect()}
    assert rows["p1"]["tokens_total"] == 5 and rows["p1"]["files"] is None and rows["p2"]["files"] == '["a"]'


def test_session_exports(spark, scratch):
    df = spark.createDataFrame([("p1", "s1"), ("p2", "s2"), ("p3", "s1")], "part_id string, session_id string")
    one = sinks.export_session(df, "s1", scratch("one"))
    assert spark.read.parquet(one).count() == 2
    with pytest.raises(sinks.EmptyExport):
        sinks.export_session(df, "nope", scratch("none"))
    every = sinks.export_all_sessions(df, scratch("all"))
    back = read_parts(spark, every)
    assert sorted((r["part_id"], r["session_id"]) for r in back.collect()) == [("p1", "s1"), ("p2", "s2"), ("p3", "s1")]
    pruned = back.where(F.col("session_id") == "s2")
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()


def test_inventory_routes_by_prefix(spark, scratch):
    root = scratch("bucket")
    spark.range(1).write.parquet(f"{root}/conversations/parts.parquet")
    spark.range(1).write.parquet(f"{root}/sessions/s1_parts.parquet")
    spark.range(1).write.parquet(f"{root}/agent-logs.parquet")
    kinds = {r["kind"] for r in list_parquet(spark, root).collect()}
    assert kinds == {"conversations", "sessions", "logs"}
    assert list_parquet(spark, "/root/testdata/sf0.001").count() == 14


def test_cluster_by_group_splits_a_hot_group(spark, scratch):
    import glob

    rows = [("hot", f"p{i}") for i in range(600)] + [(f"s{i}", f"q{i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "session_id string, part_id string")
    clustered = sinks.cluster_by_group(df, "session_id", n=6)
    per_task = clustered.groupBy(F.spark_partition_id().alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("session_id") == "hot", 1).otherwise(0)).alias("hot"))
    stats = per_task.collect()
    assert sum(r["n"] for r in stats) == 1800
    assert sum(1 for r in stats if r["hot"] > 0) >= 2  # the hot session is split
    path = sinks.export_all_sessions(df, scratch("hot"))
    assert len(glob.glob(path.replace("file:", "") + "/session_id=hot/*.parquet")) >= 2
    assert read_parts(spark, path).where(F.col("session_id") == "hot").count() == 600


def test_upsert_rerun_replaces_the_load(spark, scratch):
    d = scratch("rerun")
    rows = spark.createDataFrame([("a", 1, "a1")], "part_id string, time_updated bigint, text string")
    tables.upsert(d, rows, 0)
    tables.upsert(d, rows, 0)
    assert tables.read_loads(spark, d).count() == 1


def test_session_export_reads_its_input_twice_and_lists_with_few_tasks(spark, scratch):
    from tracelake.sources import tables as sources

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(f"s{i % 50}", f"p{i}") for i in range(200)], "session_id string, part_id string")
    path = sinks.export_all_sessions(df.mapInArrow(count, df.schema), scratch("once"))
    assert seen.value == 2 * 200  # counted, then written
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with sources.few_listing_tasks(spark):
        assert int(spark.conf.get(key)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key, None) is None
    tasks = []
    spark.sparkContext.setJobGroup("listing", "")
    assert read_parts(spark, path, merge=False).count() == 200
    for job in spark.sparkContext.statusTracker().getJobIdsForGroup("listing"):
        stages = spark.sparkContext.statusTracker().getJobInfo(job).stageIds
        tasks += [spark.sparkContext.statusTracker().getStageInfo(k).numTasks for k in stages]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism  # 50 folders


def test_cluster_by_group_with_a_map_column(spark, scratch):
    df = spark.createDataFrame([("s1", {"k": "v"}), ("s2", None)], "session_id string, extras map<string,string>")
    path = sinks.export_all_sessions(df, scratch("maps"))
    assert spark.read.parquet(path).count() == 2


def test_as_of_ties_on_time_go_to_the_later_load(spark, scratch):
    d = scratch("ties")
    schema = "part_id string, time_updated bigint, text string"
    tables.upsert(d, spark.createDataFrame([("a", 5, "first")], schema), 0)
    tables.upsert(d, spark.createDataFrame([("a", 5, "second")], schema), 1)
    assert tables.as_of(spark, d).first()["text"] == "second"
    assert tables.as_of(spark, d, 0).first()["text"] == "first"


def test_as_of_time(spark, scratch):
    import time

    d = scratch("by-time")
    schema = "part_id string, time_updated bigint, text string"
    tables.upsert(d, spark.createDataFrame([("a", 1, "v1")], schema), 0)
    cut = tables.load_history(spark, d).first()["committed_at"]
    time.sleep(1.1)
    tables.upsert(d, spark.createDataFrame([("a", 2, "v2"), ("b", 2, "b")], schema), 1)
    then = {r["part_id"]: r["text"] for r in tables.as_of_time(spark, d, cut).collect()}
    assert then == {"a": "v1"}
    assert {r["part_id"] for r in tables.as_of_time(spark, d, "2999-01-01").collect()} == {"a", "b"}


def test_bucketed_table_aggregates_without_a_shuffle(spark, scratch):
    from tracelake.operators.sessions import session_metrics

    rows = [(f"p{i}", f"s{i % 7}", f"m{i % 13}", None, 0.5, 3) for i in range(200)]
    parts = spark.createDataFrame(rows, "part_id string, session_id string, message_id string, tool string, "
                                        "cost double, tokens_total bigint")
    tables.create_table_once(spark, "tl_bucketed", "parts", parts, location=scratch("bwh"), bucket_by=("session_id", 4))
    stored = spark.table("tl_bucketed.parts")
    counts = stored.groupBy("session_id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert session_metrics(stored).count() == 7
