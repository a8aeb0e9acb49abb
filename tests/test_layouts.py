"""Session buckets, writes in one evaluation, listings with rows."""

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tracelake.plans import tables
from tracelake.sources import sinks
from tracelake.sources.tables import count_parquet, read_parts, read_session

SCHEMA = StructType([StructField("session_id", StringType()), StructField("n", LongType()), StructField("x", StringType())])


def _rows(spark, n=3000):
    session = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 40))
    return spark.range(n).select(session.alias("session_id"), F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 512).alias("x"))


def test_session_buckets(spark, scratch):
    df = _rows(spark)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        path = sinks.export_session_buckets(df, scratch("buckets"), buckets=8)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.where("session_id IS NULL").count() == df.where("session_id IS NULL").count()
    folders = glob.glob(path.removeprefix("file:") + "/of=8/bucket=*")
    assert 1 < len(folders) <= 8
    # the hot session's bucket became several files, the sessions no folder each
    hot = {r["f"] for r in back.where("session_id = 'hot'").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert len(hot) >= 2
    sinks.export_session_buckets(df.where("session_id = 's4'"), f"{path}/more", buckets=3)


def test_one_session_reads_its_bucket_alone(spark, scratch):
    df = _rows(spark)
    path = sinks.export_session_buckets(df, scratch("buckets"), buckets=8)
    for name in ("hot", "s4", "no such session"):
        got = read_session(spark, path, name, SCHEMA)
        assert got.columns == SCHEMA.fieldNames()
        assert got.count() == df.where(F.col("session_id") == name).count()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan and "session_id,%s" % name in plan
    one = read_session(spark, path, "s4", SCHEMA)
    bucket = one.select(F.regexp_extract(F.col("_metadata.file_path"), r"bucket=(\d+)", 1).alias("b")).distinct().collect()
    assert len(bucket) == 1


def test_writes_evaluate_the_input_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        seen.add(1)
        return n

    df = spark.range(500).select(counted("id").alias("time_created"), (F.col("id") % 3).alias("month").cast("string"), F.lit("s").alias("session_id"))
    tables.write_partitioned(df, scratch("months"), by="month")
    assert seen.value == 500
    sinks.export_session_buckets(df.withColumn("part_id", F.col("month")), scratch("buckets"), buckets=4)
    assert seen.value == 1000


def test_listing_with_rows(spark, scratch):
    root = scratch("lake")
    spark.range(7).write.parquet(f"{root}/a b.parquet")
    spark.range(5).selectExpr("'x' AS id", "1.5 AS y").coalesce(1).write.parquet(f"{root}/sessions/c.parquet")
    spark.range(5).limit(0).coalesce(1).write.parquet(f"{root}/empty.parquet")
    found = count_parquet(spark, root).collect()
    rows = {}
    for r in found:
        rows[r["key"].split(".parquet")[0]] = rows.get(r["key"].split(".parquet")[0], 0) + r["rows"]
    assert rows == {"a b": 7, "sessions/c": 5, "empty": 0}


def test_a_missing_path_is_an_error(spark, scratch):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_parts(spark, scratch("nothing"))
