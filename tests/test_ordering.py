"""Running totals and positions per group, with ties and equal rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tracelake.plans.ordering import running_total, with_position


def _expected(rows, group=True):
    """Brute force: (group, key, value) -> multiset of (row, running total)."""
    out, held = [], {}
    for g, k, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        key = g if group else 0
        held[key] = held.get(key, 0) + v
        out.append((g, k, v, held[key]))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [(), ("g",)])
def test_running_total_with_equal_rows(spark, group):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(5), rng.randrange(1, 4)) for _ in range(300)]
    rows += [("hot", 2, 7)] * 400  # more copies than a part of a bucket
    df = spark.createDataFrame(rows, "g string, k long, v long")
    order = ["k", "v"] if group else [F.col("g"), "k", "v"]
    got = running_total(df, order, "v", "run", buckets=6, group=group)
    assert sorted(map(tuple, got.collect()), key=str) == _expected(rows, bool(group))


def test_running_total_spreads_equal_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("v"))
    out = running_total(df, ["v"], "v", "run", buckets=8)
    sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 9000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert out.agg(F.max("run")).first()[0] == sum(range(3000, 9000)) - 3000


def test_running_total_keeps_decimals_and_nulls(spark):
    cost = Decimal("0.0000000001")
    rows = [(1, cost)] * 3 + [(2, None), (3, Decimal("12345.0000000007"))]
    df = spark.createDataFrame(rows, "t int, c decimal(38,10)")
    got = sorted(tuple(r) for r in running_total(df, ["t"], "c", "run", buckets=3).select("t", "run").collect())
    assert [g[1] for g in got] == [cost, 2 * cost, 3 * cost, 3 * cost, Decimal("12345.0000000010")]


def test_positions_in_groups_cross_buckets(spark):
    rows = [("long", i) for i in range(500)] + [(f"s{i}", j) for i in range(30) for j in range(i % 4)]
    df = spark.createDataFrame(rows, "g string, t long")
    got = with_position(df, ["t"], "pos", buckets=7, group=["g"]).collect()
    assert len(got) == len(rows) and all(r["pos"] == r["t"] + 1 for r in got)
    # nothing to order
    assert with_position(df.limit(0), ["t"], "pos", group=["g"]).count() == 0


def test_rows_with_maps_stay_single(spark):
    df = spark.range(4).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id") % 2).alias("m"))
    got = with_position(df, ["k"], "pos", buckets=2).collect()
    assert sorted(r["pos"] for r in got) == [1, 2, 3, 4]
