"""Stored sketches of loads, hourly counts with late rows, large part documents."""

import datetime as dt

from pyspark.sql import functions as F

from tracelake.operators.parts import extract_fields
from tracelake.plans import sketches, tables
from tracelake.streaming import jobs


def _stored(spark, scratch):
    table_dir, sketch_dir = scratch("loads"), scratch("sketches")
    for n in range(3):
        rows = spark.range(n * 10_000, n * 10_000 + 20_000).select(
            F.concat(F.lit("p"), "id").alias("part_id"),
            F.when(F.col("id") % 3 != 0, F.col("id") % 500).alias("session_id"),  # a third without a session
            F.when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"),
        )
        tables.upsert(table_dir, rows, n)
        sketches.write_sketches(spark, table_dir, sketch_dir, n, ["part_id", "session_id"], ["x"])
    return table_dir, sketch_dir


def test_any_range_of_loads(spark, scratch):
    table_dir, sketch_dir = _stored(spark, scratch)
    bound = sketches.distinct_bound()
    assert bound < 0.04 and sketches.rank_bound() < 0.01
    for a, b, parts in ((0, 0, 20_000), (0, 1, 30_000), (None, 2, 40_000), (1, None, 30_000)):
        got = {r["column"]: r for r in sketches.distinct_in_loads(spark, sketch_dir, ["part_id", "session_id"], a, b).collect()}
        assert abs(got["part_id"]["estimate"] - parts) <= bound * parts
        assert abs(got["session_id"]["estimate"] - 500) <= bound * 500
        first, last = (a or 0) * 10_000, (2 if b is None else b) * 10_000 + 20_000
        seen = [i for n in range(a or 0, (2 if b is None else b) + 1) for i in range(n * 10_000, n * 10_000 + 20_000) if i % 7]
        for r in sketches.quartiles_in_loads(spark, sketch_dir, ["x"], a, b).collect():
            assert r["n"] == len(seen) and first <= r["estimate"] <= last
            rank = sum(i <= r["estimate"] for i in seen) / len(seen)
            assert abs(rank - r["fraction"]) <= r["bound"] + 2 / len(seen)
    # a load written again replaces its sketches
    tables.upsert(table_dir, spark.range(5).selectExpr("'p' || id AS part_id", "id AS session_id", "CAST(id AS DOUBLE) AS x"), 0)
    sketches.write_sketches(spark, table_dir, sketch_dir, 0, ["part_id", "session_id"], ["x"])
    assert sketches.distinct_in_loads(spark, sketch_dir, ["part_id"], 0, 0).first()["estimate"] == 5


def test_questions_read_sketches_only_and_empty_ranges(spark, scratch):
    _, sketch_dir = _stored(spark, scratch)
    question = sketches.distinct_in_loads(spark, sketch_dir, ["part_id"], 1, 2)
    plan = question._jdf.queryExecution().executedPlan().toString()
    assert "hll_part_id" in plan and "kll_x" not in plan and "load_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sketches.distinct_in_loads(spark, sketch_dir, ["part_id"], 8, 9).first()["estimate"] == 0
    assert sketches.quartiles_in_loads(spark, sketch_dir, ["x"], 8, 9).count() == 0


def test_late_rows_count(spark, scratch):
    root, schema = scratch("late"), "timestamp timestamp_ntz, n int"

    def hour(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    files = [[(hour(10, 5), 1), (hour(12, 30), 2), (None, 3)], [(hour(10, 10), 4), (hour(14), 5)], [(hour(10, 59), 6)] * 3, []]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{i}")
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        jobs.run(jobs.write_stream(jobs.stream_hourly_partial(src), f"{root}/out", f"{root}/ckpt"))
    got = {r["hour"].hour: (r["count"], r["settled"]) for r in jobs.read_hourly(spark, f"{root}/out").collect()}
    assert got == {10: (5, True), 12: (1, True), 14: (1, False)}


def test_documents_of_twenty_megabytes_keep_their_fields(spark):
    head = '{"type":"tool","tool":"bash","state":{"status":"completed","input":{"n":1},"output":"'
    data = F.concat(F.lit(head), F.repeat(F.lit("x"), 20_000_000), F.lit('"}}'))
    part = spark.range(1).select(
        F.lit("p").alias("id"), F.lit("m").alias("message_id"), F.lit("s").alias("session_id"), F.lit(1).alias("time_created"),
        F.lit(1).alias("time_updated"), data.alias("data"),
    )
    row = extract_fields(part).select("part_type", "tool", "tool_status", "tool_input", F.length("tool_output").alias("n")).first()
    assert tuple(row) == ("tool", "bash", "completed", '{"n":1}', 20_000_000)
