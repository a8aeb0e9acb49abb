"""Overview results on literal rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.operators import overview as ov
from tracelake.plans.ordering import running_total, with_position

LOG_SCHEMA = "timestamp string, level string, `session.id` string, `tokens.input` string, `tokens.output` string, cost string, filename string"


def _logs(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_valid_logs_and_hourly(spark):
    logs = _logs(spark, [
        ("2024-01-01T10:05:00Z", "info", "a", "1", "2", "0.5", "f1"),
        ("2024-01-01 10:59:59", None, "a", "n/a", None, "x", "f1"),
        ("2024-01-01T12:00:00", "warn", None, "3", "4", None, "f2"),
        ("bad", "info", "b", "1", "1", "1", "f2"),
    ])
    valid = ov.valid_logs(logs)
    assert valid.count() == 3
    hours = {str(r["hour"]): r["count"] for r in ov.hourly_activity(valid).collect()}
    assert hours == {"2024-01-01 10:00:00": 2, "2024-01-01 12:00:00": 1}
    assert sum(hours.values()) == valid.count()
    levels = {r["level"]: r["count"] for r in ov.level_counts(valid).collect()}
    assert levels == {"info": 1, "unknown": 1, "warn": 1}
    metrics = ov.load_metrics(logs).first()
    assert (metrics["rows"], metrics["columns"], metrics["files"]) == (4, 7, 2)


def test_tokens_bad_values_sum_to_zero(spark):
    logs = _logs(spark, [
        ("2024-01-01", "i", "a", "n/a", None, None, "f"),
        ("2024-01-01", "i", "a", "x", "1e1", None, "f"),
        ("2024-01-01", "i", None, "5", "5", None, "f"),
    ])
    long = ov.tokens_long(ov.tokens_per_session(ov.valid_logs(logs)))
    got = {(r["session_id"], r["type"]): r["tokens"] for r in long.collect()}
    assert got == {("a", "tokens.input"): 0.0, ("a", "tokens.output"): 10.0}


def test_top_sessions_ties_break_on_key(spark):
    rows = [("2024-01-01", "i", s, "0", "0", None, "f") for s in ["b", "a", "c", "c", None, None]]
    top = ov.top_sessions(ov.valid_logs(_logs(spark, rows)), k=2).collect()
    assert [(r["session"], r["count"]) for r in top] == [("c", 2), ("unknown", 2)]
    top3 = ov.top_sessions(ov.valid_logs(_logs(spark, rows)), k=3).collect()
    assert top3[2]["session"] == "a"


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_running_total_equals_single_window(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.randint(0, 20), round(rnd.choice([0.5, 1.25, 2.0, 3.75]), 2)) for _ in range(n)]
    df = spark.createDataFrame(rows, "t int, v double").withColumn("v", F.col("v").cast("decimal(38,10)"))
    two_phase = running_total(df, ["t", "v"], "v", "run", buckets=5)
    one = df.withColumn("run", F.sum("v").over(
        Window.orderBy("t", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    key = lambda r: (r["t"], r["v"], r["run"])
    assert sorted(two_phase.collect(), key=key) == sorted(one.collect(), key=key)
    if n:
        last = two_phase.agg(F.max("run")).first()[0]
        assert last == df.agg(F.sum("v")).first()[0]


def test_running_total_spreads_a_hot_key(spark):
    # A third of the rows tie on the order keys (t, v) but differ elsewhere:
    # the row-hash tiebreaker spreads them over several buckets.
    from tracelake.plans.ordering import row_hash

    rows = [(1, 1.0, f"x{i}") for i in range(300)] + [(i, 1.0, "y") for i in range(600)]
    df = spark.createDataFrame(rows, "t int, v double, other string")
    pos = with_position(df, ["t", "v"], "pos", buckets=6)
    assert sorted(r["pos"] for r in pos.collect()) == list(range(1, 901))
    sizes = [r["n"] for r in df.repartitionByRange(6, "t", "v", row_hash(df)).groupBy(
        F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 300


def test_row_hash_is_content_only(spark):
    from tracelake.plans.ordering import row_hash

    df = spark.createDataFrame([(1, {"a": "b"}), (1, {"a": "b"}), (2, None)], "k int, m map<string,string>")
    a = [r[0] for r in df.select(row_hash(df)).collect()]
    b = [r[0] for r in df.repartition(3).select(row_hash(df)).orderBy(F.col(df.columns[0])).collect()]
    assert a[0] == a[1] != a[2] and sorted(a) == sorted(b)


def test_cumulative_cost_plan_has_no_single_partition(spark):
    logs = _logs(spark, [(f"2024-01-0{1 + i % 9}", "i", "a", "1", "1", str(i), "f") for i in range(50)])
    out = ov.cumulative_cost(ov.valid_logs(logs))
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Rows are windowed per bucket; the one single-partition step is the
    # bucket-offset table, under the broadcast.
    assert "hashpartitioning(_tl_bucket" in plan
    assert plan.count("SinglePartition") == 1
    assert plan.index("BroadcastExchange") < plan.index("SinglePartition")
    assert float(out.agg(F.max("cumulative")).first()[0]) == float(sum(range(50)))


def test_cumulative_cost_edge_rows(spark):
    logs = _logs(spark, [("2024-01-01", "i", "a", "1", "1", None, "f"), ("bad", "i", "a", "1", "1", "2", "f")])
    assert ov.cumulative_cost(ov.valid_logs(logs)).count() == 0
    one = _logs(spark, [("2024-01-01", "i", "a", "1", "1", "2.5", "f")])
    assert float(ov.cumulative_cost(ov.valid_logs(one)).first()["cumulative"]) == 2.5


def test_describe_matches_pandas(spark):
    rnd = random.Random(3)
    pdf = pd.DataFrame({"a": [rnd.randint(0, 100) for _ in range(101)], "b": [rnd.random() * 10 for _ in range(101)]})
    out = {r["column"]: r for r in ov.describe(spark.createDataFrame(pdf)).collect()}
    ref = pdf.describe()
    for c in ("a", "b"):
        for stat, name in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                           ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max")]:
            assert out[c][name] == pytest.approx(ref.loc[stat, c], rel=1e-9), (c, stat)


def test_describe_text(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("x",), (None,), ("z",)], "s string")
    r = ov.describe(df).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "x", 2)


def test_describe_approx_close_to_exact(spark):
    df = spark.range(1, 10001).select((F.col("id") * 1.0).alias("x"))
    exact = ov.describe(df).first()
    approx = ov.describe(df, exact=False).first()
    assert approx["count"] == exact["count"] and approx["mean"] == pytest.approx(exact["mean"])
    for q in ("p25", "p50", "p75"):
        assert approx[q] == pytest.approx(exact[q], rel=1e-3)


def test_values_at_positions_with_a_hot_value(spark):
    from tracelake.plans.ordering import values_at_positions

    vals = [5] * 300 + list(range(600))
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    ordered = sorted(vals)
    want = [1, 300, 301, 450, 900]
    picked, n = values_at_positions(df, "x", want, buckets=6)
    assert n == 900
    assert {r["pos"]: r["v"] for r in picked.collect()} == {p: ordered[p - 1] for p in want}


def test_describe_one_row_and_empty(spark):
    one = ov.describe(spark.createDataFrame([(7,)], "x int")).first()
    assert (one["count"], one["min"], one["p25"], one["p50"], one["max"]) == (1, 7.0, 7.0, 7.0, 7.0)
    assert one["std"] is None
    empty = ov.describe(spark.createDataFrame([], "x int")).first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_describe_logs_falls_back_to_time(spark):
    import datetime as dt

    logs = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h), "info") for h in range(5)], "timestamp timestamp_ntz, level string")
    r = ov.describe(logs).first()
    assert r["column"] == "timestamp" and r["count"] == 5
    assert r["p50"] == dt.datetime(2024, 1, 1, 2) and r["mean"] == dt.datetime(2024, 1, 1, 2)


def test_describe_ignores_nan_like_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, float("nan"), 3.0, 4.0]})
    r = ov.describe(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (4.0,)], "x double")).first()
    ref = pdf.describe()["x"]
    assert r["count"] == ref["count"] and r["mean"] == pytest.approx(ref["mean"])
    assert r["p50"] == pytest.approx(ref["50%"]) and r["max"] == ref["max"]
