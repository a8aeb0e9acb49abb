"""Heterogeneous log files by name, schema listing."""

import datetime as dt

from pyspark.sql import functions as F

from tracelake.operators import overview as ov
from tracelake.operators import sessions
from tracelake.sources.logs import read_logs


def test_union_by_name_with_conflicting_types(spark, scratch):
    root = scratch("mixed")
    spark.createDataFrame([("2024-01-01T00:00:00Z", "info", "1.5", "x")],
                          "timestamp string, level string, cost string, other string").write.parquet(f"{root}/a")
    spark.createDataFrame([(dt.datetime(2024, 1, 2), 2.25, 7)],
                          "timestamp timestamp_ntz, cost double, `session.id` int").write.parquet(f"{root}/b")
    logs = read_logs(spark, [f"{root}/a", f"{root}/b"])
    rows = {r["level"]: r for r in logs.collect()}
    assert rows["info"]["cost"] == "1.5" and rows["info"]["extras"] == {"other": "x"}
    assert rows[None]["cost"] == "2.25" and rows[None]["session.id"] == "7"
    assert rows[None]["timestamp"] == dt.datetime(2024, 1, 2)
    assert {r["filename"].rstrip("/").split("/")[-2] for r in logs.collect()} == {"a", "b"}


def test_union_by_name_same_types(spark, scratch):
    root = scratch("same")
    spark.createDataFrame([("2024-01-01", "info")], "timestamp string, level string").write.parquet(f"{root}/a")
    spark.createDataFrame([("2024-01-02", "s1")], "timestamp string, `session.id` string").write.parquet(f"{root}/b")
    logs = read_logs(spark, [f"{root}/a", f"{root}/b"])
    assert logs.count() == 2 and logs.where(F.col("level").isNull()).count() == 1


def test_schema_of(spark):
    df = spark.createDataFrame([(1, "a")], "n bigint, s string")
    assert [(r["position"], r["column"], r["type"]) for r in ov.schema_of(df).collect()] == [
        (0, "n", "bigint"), (1, "s", "string")]


def test_approx_distinct_option(spark):
    parts = spark.createDataFrame([("s1", f"p{i}", f"m{i % 5}", None, None, None) for i in range(20)],
                                  "session_id string, part_id string, message_id string, tool string, cost double, tokens_total bigint")
    exact = sessions.session_metrics(parts).first()
    approx = sessions.session_metrics(parts, approx_distinct=True).first()
    assert exact["nb_messages"] == 5 and approx["nb_messages"] == 5


def test_read_parts_written_by_pandas(spark, scratch):
    import pandas as pd

    from tracelake.sources.tables import read_parts

    path = scratch("pandas-parts")
    pdf = pd.DataFrame({"part_id": ["p1", "p2"], "session_id": ["s1", "s1"], "time_created": [1, 2],
                        "part_type": ["step-finish", "text"], "tokens_total": [91.0, float("nan")],
                        "cost": [0.5, float("nan")], "text": [None, "hi"]})
    import os
    local = path.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    pdf.to_parquet(f"{local}/parts.parquet", index=False)
    rows = {r["part_id"]: r for r in read_parts(spark, path).collect()}
    assert rows["p1"]["tokens_total"] == 91 and rows["p2"]["tokens_total"] is None
    assert rows["p2"]["text"] == "hi" and rows["p1"]["files"] is None


def test_zoned_log_timestamps_become_utc(spark, scratch):
    root = scratch("zoned")
    spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:00 UTC' AS timestamp, 'info' AS level").write.parquet(f"{root}/a")
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        ts = read_logs(spark, [f"{root}/a"]).first()["timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert ts == dt.datetime(2024, 1, 1, 10, 0)


def test_union_groups_paths_by_schema(spark, scratch):
    root = scratch("groups")
    for i in range(3):
        spark.createDataFrame([(f"2024-01-0{i + 1}", "1.5")], "timestamp string, cost string").write.parquet(f"{root}/s{i}")
    spark.createDataFrame([(dt.datetime(2024, 1, 9), 2.5)], "timestamp timestamp_ntz, cost double").write.parquet(f"{root}/d")
    logs = read_logs(spark, [f"{root}/s0", f"{root}/s1", f"{root}/s2", f"{root}/d"])
    assert logs.count() == 4
    plan = logs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # one scan per distinct schema


def _written(folder, **files):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    local = folder.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    for name, columns in files.items():
        pq.write_table(pa.table(columns), f"{local}/{name}.parquet")


def test_read_parts_of_unlike_types(spark, scratch):
    import pyarrow as pa

    from tracelake.sources.tables import read_parts

    path = scratch("unlike parts")
    _written(
        path,
        a={"part_id": ["a"], "tokens_total": [1], "time_created": pa.array([5], pa.int32())},
        b={"part_id": ["b"], "tokens_total": [2.0], "cost": [0.5]},
        c={"part_id": ["c"], "tokens_total": ["3"], "time_created": pa.array([6], pa.int64())},
        d={"part_id": ["d"], "tokens_total": pa.nulls(1), "part_id_": [1]},
        e={"part_id": [7], "tokens_total": ["n/a"]},
        f={"part_id": pa.array([], pa.string()), "tokens_total": pa.array([], pa.bool_())},
    )
    own = read_parts(spark, path)
    got = {r["part_id"]: (r["tokens_total"], r["time_created"], r["cost"]) for r in own.collect()}
    assert got == {"a": (1, 5, None), "b": (2, None, 0.5), "c": (3, 6, None), "d": (None, None, None), "7": (None, None, None)}


def test_unlike_types_below_partition_folders(spark, scratch):
    from tracelake.sources.tables import read_parts

    path = scratch("unlike-folders")
    for s, kind in (("s1", "int"), ("s2", "double"), ("s3", "string"), ("s4", "int")):
        spark.sql(f"SELECT 'p{s}' AS part_id, CAST(4 AS {kind}) AS tokens_total").write.parquet(f"{path}/session_id={s}")
    own = read_parts(spark, path)
    assert {(r["part_id"], r["session_id"], r["tokens_total"]) for r in own.collect()} == {(f"ps{i}", f"s{i}", 4) for i in (1, 2, 3, 4)}
    assert own._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3  # one scan per type, not per file


def test_agreeing_types_share_a_scan():
    from tracelake.sources.mixed import agreeing

    assert agreeing([{"a": "int"}, {"b": "int"}, {"a": "text", "b": "int"}, {"b": "text"}, {"a": "int", "b": "int"}, {}]) == [
        [0, 1, 4, 5], [2], [3]]


def test_other_read_errors_are_raised(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException

    from tracelake.sources.tables import read_parts

    with pytest.raises(AnalysisException):
        read_parts(spark, scratch("nothing here"))
    with pytest.raises(AnalysisException):
        read_logs(spark, [scratch("nothing there")])
