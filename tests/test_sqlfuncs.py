"""SQL functions against the DataFrame expressions they stand for."""

import pytest
from pyspark.sql import functions as F

from tracelake import fixtures as fx
from tracelake.functions import scalars
from tracelake.operators import sessions as sess
from tracelake.operators import timeline as tl
from tracelake.plans import sqlapi, sqlfuncs

SF = "/root/testdata/sf0.001"
TIMES = ["2024-05-01", "2024-05-01T10:00:00", "2024-05-01T10:00:00Z", "2024-05-01T10:00:00+02:00", " 2024-05-01 10:00:00.25 ",
         "2024-05-01T10:00:00+0530", "bad", "", None, "10:00", "2024-13-01"]
NUMBERS = ["1", " 2.5 ", "-.5", "1e3", "nan", "NaN", "inf", "-Infinity", "1d", "0x1", "", None, "1.", "."]
LISTS = ['["a","b"]', "[]", ' ["x"]', "{}", '"a"', "[1, 2]", "null", "", None, "[broken"]
DOUBLES = [0.0, 1.0, 0.01, 0.0001, 0.00001, 1e7, 123456789.5, 1e15, 1e16, 1.5e300, -2.5e-7, None]


@pytest.mark.parametrize(
    ("name", "values", "kind", "expression"),
    [
        ("lenient_time", TIMES, "string", scalars.to_ts),
        ("lenient_number", NUMBERS, "string", scalars.lenient_double),
        ("file_list", LISTS, "string", scalars.json_list),
        ("number_text", DOUBLES, "double", scalars.number_text),
        ("epoch_time", [0, 1704067200123, -5, None], "long", scalars.epoch_ms),
    ],
)
def test_scalars(spark, name, values, kind, expression):
    sqlfuncs.register_functions(spark)
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    df.createOrReplaceTempView("given")
    want = [r[0] for r in df.select(expression("v")).collect()]
    assert [r[0] for r in spark.sql(f"SELECT {name}(v) FROM given").collect()] == want


def test_hours_and_labels(spark):
    sqlfuncs.register_functions(spark)
    row = spark.sql("SELECT hour_of(lenient_time('2024-05-01T10:59:59')) AS h, session_label(NULL, 's1') AS a, session_label(repeat('x', 70), 's') AS b").first()
    assert str(row["h"]) == "2024-05-01 10:00:00" and row["a"] == " (s1)" and row["b"] == "x" * 60 + " (s)"


def test_table_functions(spark):
    parts = fx.fx_parts(spark, SF, whole=True)
    sqlapi.register_views(spark, {"parts": parts, "sessions": fx.fx_sessions(spark, SF)})
    assert {"timelines", "session_summaries"} <= set(sqlfuncs.register_functions(spark))

    def same(a, b):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    want = tl.timelines(parts, n=3)
    same(spark.sql("SELECT * FROM timelines(3)").select(*want.columns), want)
    summary = sess.session_summary(fx.fx_sessions(spark, SF), parts)
    summary = summary.withColumn("cost", F.col("cost").cast("double")).withColumn("tokens", F.col("tokens").cast("bigint"))
    same(spark.sql("SELECT * FROM session_summaries()").select(*summary.columns), summary)
    # a filter on the result reaches the view under it
    plan = spark.sql("SELECT * FROM timelines(3) WHERE session_id = 's1'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("= s1") >= 2


def test_the_total_comes_from_the_same_run(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(n):
        seen.add(1)
        return n

    spark.udf.register("counted", counted, "long")
    res = sqlapi.run_sql(spark, "SELECT counted(id) AS n FROM range(0, 700, 1, 5)", max_rows=10, with_total=True)
    assert res.total_rows == 700 and res.truncated and res.count == 10
    assert seen.value == 700
    res = sqlapi.run_sql(spark, "SELECT id FROM range(0, 700, 1, 5) ORDER BY id DESC", max_rows=10, with_total=True)
    assert res.total_rows == 700 and [r[0] for r in res.rows] == list(range(699, 689, -1))
    none = sqlapi.run_sql(spark, "SELECT id, make_interval(1) AS i FROM range(5) WHERE id > 9", with_total=True)
    assert none.total_rows == 0 and none.rows == [] and none.columns == ["id", "i"]
