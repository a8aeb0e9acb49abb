"""The log line parser against Python's own regex semantics."""

import re

import pytest
from pyspark.sql import functions as F

from tracelake.functions.logparse import PAIR_RE, parse_log_lines
from tracelake.sources.logs import read_log_lines, read_text_logs

LINES = [
    'k="a b=c" x=1',
    'k=""',
    "k=",
    'z="open',
    "k=v=w",
    "a-b=3",
    "é=1 clé=valeur",
    "a=1 b=2\tc=3",
    'q="a \\"b\\""',
    "dup=1 dup=2 dup=3",
    "no pair here",
    "timestamp=2024-01-01T10:00:00Z level=info session.id=ses_1 cost=0.5 extra=yes",
    "x.y.z=1 _u=2 9=nine",
    'k="',
    'k=""x y=1',
    'k="a"b c="d e"f',
    'k="a=b" a=="x"',
    'k=\'q\' z="" w="="',
]


def python_parse(line):
    pattern = PAIR_RE.replace("(?U)", "")
    return {k: (v2 if v2 else v3) for k, v2, v3 in re.findall(pattern, line)}


def _as_dict(row):
    d = {}
    for name in ("timestamp", "level", "type", "session.id", "tokens.input", "tokens.output", "cost"):
        if row[name] is not None:
            d[name] = row[name]
    d.update(row["extras"] or {})
    return d


def test_pairs_match_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(LINES)], "i int, value string")
    out = parse_log_lines(df.drop("i"), strict=False).withColumn("timestamp", F.col("timestamp").cast("string"))
    rows = out.collect()
    for line, row in zip(LINES, rows):
        expected = python_parse(line)
        got = _as_dict(row)
        if "timestamp" in expected:
            assert got.pop("timestamp") is not None
            expected.pop("timestamp")
        assert got == expected, line


def test_empty_and_missing_are_different(spark):
    df = spark.createDataFrame([("level= type=x",), ("type=y",)], "value string")
    rows = parse_log_lines(df, strict=False).orderBy("type").collect()
    assert rows[0]["level"] == "" and rows[1]["level"] is None


def test_strict_timestamp_fails(spark):
    df = spark.createDataFrame([("timestamp=bad level=x",)], "value string")
    with pytest.raises(Exception):
        parse_log_lines(df, strict=True).collect()
    assert parse_log_lines(df, strict=False).first()["timestamp"] is None


def test_session_filter_and_blank_lines(spark, scratch):
    path = scratch("lines")
    text = ["session.id=a n=1", "", "   ", "session.id=b n=2", "session.id=ab n=3"]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    assert read_log_lines(spark, path).count() == 3
    only_a = read_text_logs(spark, path, session_id="a", strict=False).collect()
    assert [r["extras"]["n"] for r in only_a] == ["1"]
    assert all(r["filename"] for r in only_a)
