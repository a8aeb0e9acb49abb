"""Scalar expressions on literal rows."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tracelake.functions.scalars import (
    blank_to, epoch_ms, json_list, lenient_double, session_label, to_ts, truncate,
)


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_lenient_timestamps(spark):
    cases = {
        "2024-01-01T10:00:00.5Z": dt.datetime(2024, 1, 1, 10, 0, 0, 500000),
        "2024-01-01T12:00:00+02:00": dt.datetime(2024, 1, 1, 10, 0, 0),
        "2024-01-01 10:00:00": dt.datetime(2024, 1, 1, 10, 0, 0),
        "2024-01-01": dt.datetime(2024, 1, 1),
        "bad": None,
        "": None,
        None: None,
    }
    for text, expected in cases.items():
        assert _one(spark, to_ts, text) == expected, text


def test_lenient_numbers(spark):
    cases = {
        " 1 ": 1.0, "+2": 2.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "inf": math.inf,
        "nan": None, "1d": None, "1f": None, "0x10": None, "1_000": None, "true": None, "": None, "1,5": None,
        "n/a": None, None: None, "-3.25": -3.25,
    }
    for text, expected in cases.items():
        assert _one(spark, lenient_double, text) == expected, text


def test_epoch_ms_is_utc(spark):
    assert _one(spark, epoch_ms, 1704067200000, "bigint") == dt.datetime(2024, 1, 1)


def test_json_list(spark):
    cases = {
        '["a","b"]': ["a", "b"],
        "[]": [],
        '["a",null]': ["a", None],
        "null": None,
        '{"a":1}': None,
        '"abc"': None,
        "bad": None,
        None: None,
    }
    for text, expected in cases.items():
        assert _one(spark, json_list, text) == expected, text


def test_truncate_counts_code_points(spark):
    s = "é" * 70 + "😀" * 5
    assert _one(spark, lambda c: truncate(c, 72), s) == s[:72]


def test_placeholders_and_label(spark):
    assert _one(spark, lambda c: blank_to(c, "?"), "") == "?"
    assert _one(spark, lambda c: blank_to(c, "?"), None) == "?"
    assert _one(spark, lambda c: blank_to(c, "?"), "bash") == "bash"
    row = spark.createDataFrame([("t" * 80, "s1")], "title string, id string").select(
        session_label("title", "id").alias("l")
    ).first()
    assert row["l"] == "t" * 60 + " (s1)"


def test_utc_wall_clock_by_type(spark):
    from pyspark.sql import types as T

    from tracelake.functions.scalars import utc_wall_clock

    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 10:00:00 UTC' AS t, "
                        "TIMESTAMP_NTZ'2024-01-02 10:00:00' AS n, '2024-01-02T10:00:00Z' AS s").select(
            utc_wall_clock("d", T.DateType()).alias("d"), utc_wall_clock("t", T.TimestampType()).alias("t"),
            utc_wall_clock("n", T.TimestampNTZType()).alias("n"), utc_wall_clock("s", T.StringType()).alias("s"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert row["d"] == dt.datetime(2024, 1, 2)
    assert row["t"] == row["n"] == row["s"] == dt.datetime(2024, 1, 2, 10)
