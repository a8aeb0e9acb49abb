"""Edge rows of times, number text, versioned tables and session joins."""

from pyspark.sql import functions as F

from tracelake.functions.scalars import epoch_ms, hour_floor, number_text, to_ts
from tracelake.operators import overview as ov
from tracelake.operators.sessions import logs_by_session
from tracelake.operators.timeline import timeline
from tracelake.plans import tables


def test_times_around_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [(1730611800000, "2024-11-03T05:30:00Z"), (1730615400000, "2024-11-03T06:30:00+00:00"),
                (1710052200000, "2024-03-10T02:30:00-04:00"), (-1800000, "1969-12-31T23:30:00Z"), (None, None)]
        df = spark.createDataFrame(rows, "ms bigint, s string").select(epoch_ms("ms").alias("a"), to_ts("s").alias("b"))
        got = df.select(F.col("a").cast("string"), F.col("b").cast("string"), hour_floor("a").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [tuple(r) for r in got] == [
        ("2024-11-03 05:30:00", "2024-11-03 05:30:00", "2024-11-03 05:00:00"),
        ("2024-11-03 06:30:00", "2024-11-03 06:30:00", "2024-11-03 06:00:00"),
        ("2024-03-10 06:30:00", "2024-03-10 06:30:00", "2024-03-10 06:00:00"),
        ("1969-12-31 23:30:00", "1969-12-31 23:30:00", "1969-12-31 23:00:00"),
        (None, None, None),
    ]


def test_hour_that_a_zone_skips(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS t").select(hour_floor("t").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == "2024-03-10 02:00:00"


def test_numbers_print_as_python_prints_them(spark):
    values = [0.00045, 0.0001, 0.00001, 1.5e-07, 1e-100, 0.25, 0.0, -0.00045, 12345678.0, 12345678.25, 1e15, 1e16, -3e22, 1e100]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(number_text("v")).collect()] == [repr(v) for v in values]


def test_small_cost_in_a_timeline(spark):
    schema = ("part_id string, session_id string, time_created bigint, role string, part_type string, text string, tool string, "
              "tool_status string, tool_input string, tool_output string, tokens_total bigint, cost double, files string")
    row = ("p", "s", 1, None, "step-finish", None, None, None, None, None, 13, 0.00045, None)
    assert timeline(spark.createDataFrame([row], schema), "s").first()["body"] == "13 tokens · 0.00045"


def test_null_keys_are_kept(spark):
    rows = [(None, 1, "x"), (None, 2, "y"), ("a", 1, "old"), ("a", 2, "new")]
    df = spark.createDataFrame(rows, "part_id string, time_updated bigint, text string")
    assert sorted(r["text"] for r in tables.latest(df).collect()) == ["new", "x", "y"]


def test_as_of_with_a_column_of_a_later_load(spark, scratch):
    d = scratch("added")
    schema = "part_id string, time_updated bigint"
    tables.upsert(d, spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    tables.upsert(d, spark.createDataFrame([("b", 2, '["f"]')], schema + ", files string"), 1)
    assert {r["part_id"]: r["files"] for r in tables.as_of(spark, d).collect()} == {"a": None, "b": '["f"]'}


def test_sessions_of_one_side_only(spark):
    logs = spark.createDataFrame([("l",), ("l",), (None,)], "`session.id` string")
    sessions = spark.createDataFrame([("s", "t")], "id string, title string")
    parts = spark.createDataFrame([("p", "x"), ("q", None)], "part_id string, session_id string")
    got = {tuple(r) for r in logs_by_session(logs, sessions, parts).collect()}
    assert got == {("l", None, 2, None), ("s", "t", None, None), ("x", None, None, 1)}


def test_describe_time_without_a_time(spark):
    import pytest

    with pytest.raises(ValueError):
        ov.describe_time(spark.range(1))
