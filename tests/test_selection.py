"""Order statistics by sketches, against sorted lists and pandas."""

import datetime as dt
import random
from decimal import Decimal
from math import inf

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracelake.operators import overview as ov
from tracelake.plans.selection import interpolated, order_statistics, quartile_positions

Q = (0.0, 0.25, 0.5, 0.75, 1.0)


def _check(df, columns, rows, **settings):
    counts, found, _ = order_statistics(df, {c: F.col(c) for c in columns}, Q, **settings)
    for i, c in enumerate(columns):
        ordered = sorted(r[i] for r in rows if r[i] is not None)
        assert counts[c] == len(ordered)
        for q in Q if ordered else ():
            a, b, between = quartile_positions(len(ordered), q)
            assert found[c, q] == (ordered[a - 1], ordered[b - 1], between), (c, q)
    return found


@pytest.mark.parametrize(("limit", "accuracy"), [(100_000, 10_000), (20, 50), (1, 8)])
def test_positions_equal_a_sort(spark, limit, accuracy):
    rng = random.Random(limit)
    rows = [
        (
            rng.choice([None, 7, 7, rng.randrange(2**60, 2**60 + 300), rng.randrange(100)]),
            rng.choice([-inf, inf, 0.0, 0.5, rng.random(), rng.random() * 1e9, None]),
            Decimal(rng.randrange(10**20)) / 1000 if rng.random() < 0.7 else Decimal("5.001"),
            rng.choice([1, 2]),  # two hot values
            None,
        )
        for _ in range(700)
    ]
    df = spark.createDataFrame(rows, "a long, b double, c decimal(30,3), d int, e long").repartition(4)
    _check(df, "abcde", rows, limit=limit, accuracy=accuracy)


def test_few_rows(spark):
    for n in range(4):
        rows = [(i * 3,) for i in range(n)]
        _check(spark.createDataFrame(rows, "a int"), "a", rows, limit=1, accuracy=8)


def test_one_pass_for_all_columns(spark):
    df = spark.range(3000).select(*[(F.col("id") * (i + 1) % 1009).alias(f"c{i}") for i in range(6)])
    tracker = spark.sparkContext.statusTracker()

    def jobs(columns):
        group = f"describe-{len(columns)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            ov.describe(df, columns)
            return len(tracker.getJobIdsForGroup(group))
        finally:
            spark.sparkContext._jsc.sc().clearJobGroup()

    assert jobs([f"c{i}" for i in range(6)]) == jobs(["c0"])


def test_mixed_frame_equals_pandas(spark):
    rng = random.Random(9)
    t0 = dt.datetime(2024, 3, 1)
    pdf = pd.DataFrame({
        "n": [rng.randrange(50) for _ in range(101)],
        "at": [t0 + dt.timedelta(seconds=rng.randrange(10**6)) for _ in range(101)],
        "x": [rng.random() for _ in range(101)],
        "s": ["text"] * 101,
    })
    df = spark.createDataFrame(pdf).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = {r["column"]: r for r in ov.describe(df).collect()}
    want = pdf.describe()
    assert list(got) == ["n", "at", "x"] and [got[c]["kind"] for c in got] == ["number", "time", "number"]
    names = {"mean": "mean", "std": "std", "min": "min", "25%": "p25", "50%": "p50", "75%": "p75", "max": "max"}
    for c in ("n", "x"):
        assert got[c]["count"] == 101 and got[c]["mean_at"] is None
        for stat, name in names.items():
            assert got[c][name] == pytest.approx(want.loc[stat, c], rel=1e-9)
    assert got["at"]["mean"] is None
    for stat, name in names.items():
        if stat != "std":
            assert abs(pd.Timestamp(got["at"][f"{name}_at"]) - want.loc[stat, "at"]) <= pd.Timedelta(microseconds=1)
    empty = {r["column"]: r for r in ov.describe(df.limit(0)).collect()}
    assert empty["at"]["count"] == 0 and empty["at"]["min_at"] is None and empty["x"]["mean"] is None


def test_interpolation():
    assert interpolated(3, 4, 0.25) == 3.25 and interpolated(inf, inf, 0.5) == inf
    assert interpolated(Decimal("1.5"), Decimal("2.5"), 0.5) == 2.0
