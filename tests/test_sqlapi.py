"""S12, S14, S15, Q1, Q2."""

import base64
import datetime as dt
import decimal

import pytest

from tracelake.plans import sqlapi


def test_clean_sql():
    assert sqlapi.clean_sql("  SELECT 1 ;  ") == "SELECT 1"
    assert sqlapi.clean_sql("SELECT 1;;") == "SELECT 1"
    assert sqlapi.clean_sql("SELECT ';' AS a ; ;\n") == "SELECT ';' AS a"
    for empty in ("  ; ", "; ;", ""):
        with pytest.raises(ValueError):
            sqlapi.clean_sql(empty)
    with pytest.raises(ValueError):
        sqlapi.clean_sql(None)


def test_run_sql_caps_rows(spark):
    spark.range(5000).createOrReplaceTempView("numbers")
    res = sqlapi.run_sql(spark, "SELECT id FROM numbers ORDER BY id;", max_rows=2000)
    assert res.columns == ["id"] and res.count == 2000 and res.rows[-1] == [1999] and res.total_rows is None
    res = sqlapi.run_sql(spark, "SELECT id FROM numbers", max_rows=10, with_total=True)
    assert res.count == 10 and res.total_rows == 5000 and res.elapsed_ms >= 0 and res.truncated
    assert not sqlapi.run_sql(spark, "SELECT 1", max_rows=1).truncated
    assert sqlapi.sql_frame(spark, "SELECT id FROM numbers").count() == 5000


def test_run_sql_star_of_a_join(spark):
    spark.sql("SELECT 1 AS id, named_struct('a', 1) AS s").createOrReplaceTempView("one")
    spark.sql("SELECT 1 AS id, CAST(NULL AS struct<a:int>) AS s").createOrReplaceTempView("two")
    res = sqlapi.run_sql(spark, "SELECT * FROM one JOIN two ON one.id = two.id", with_total=True)
    assert res.columns == ["id", "s", "id", "s"]
    assert res.rows == [[1, {"a": 1}, 1, None]] and res.total_rows == 1


def test_register_views(spark):
    names = sqlapi.register_views(spark, {"parts": spark.range(3), "sessions": spark.range(2)})
    assert names == ["parts", "sessions"]
    assert spark.sql("SELECT count(*) FROM parts").first()[0] == 3


def test_json_safe_types(spark):
    df = spark.sql("""SELECT CAST(NULL AS string) AS n, true AS b, DATE'2024-01-02' AS d,
        TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t0, TIMESTAMP_NTZ'2024-01-02 03:04:05.25' AS t1,
        CAST(1.50 AS DECIMAL(5,2)) AS dec, CAST('hi' AS BINARY) AS bin, array(1, 2) AS arr,
        map(1, 'a') AS m, named_struct('x', DATE'2024-01-02') AS st, INTERVAL '1' DAY AS iv""")
    row = sqlapi.json_safe(df).first().asDict(recursive=True)
    assert row["n"] is None and row["b"] is True and row["d"] == "2024-01-02"
    assert row["t0"] == dt.datetime(2024, 1, 2, 3, 4, 5).isoformat()
    assert row["t1"] == dt.datetime(2024, 1, 2, 3, 4, 5, 250000).isoformat()
    assert row["dec"] == float(decimal.Decimal("1.50"))
    assert row["bin"] == base64.b64encode(b"hi").decode("ascii")
    assert row["arr"] == [1, 2] and row["m"] == {"1": "a"} and row["st"] == {"x": "2024-01-02"}
    assert isinstance(row["iv"], str)


def test_run_sql_rows_are_json_encodable(spark):
    import json

    res = sqlapi.run_sql(spark, "SELECT named_struct('a', 1, 'd', DATE'2024-01-02') AS s, map('k', 1.5BD) AS m, "
                                "array(TIMESTAMP_NTZ'2024-01-02 00:00:00') AS t")
    text = json.dumps(res.rows)
    assert json.loads(text) == [[{"a": 1, "d": "2024-01-02"}, {"k": 1.5}, ["2024-01-02T00:00:00"]]]


def test_json_rows_keep_nulls(spark):
    import json

    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, DATE'2024-01-02' AS d")
    assert json.loads(sqlapi.json_rows(df).first()["json"]) == {"a": 1, "b": None, "d": "2024-01-02"}
