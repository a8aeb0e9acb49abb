"""SURVEY §5 invariants on the driver's smallest tables."""

from pyspark.sql import functions as F

from tracelake import fixtures as fx
from tracelake.operators import files, overview as ov, sessions
from tracelake.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_hourly_sums_to_valid_rows(spark):
    valid = ov.valid_logs(fx.fx_logs(spark, SF))
    assert ov.hourly_activity(valid).agg(F.sum("count")).first()[0] == valid.count()


def test_last_cumulative_is_total_cost(spark):
    valid = ov.valid_logs(fx.fx_logs(spark, SF))
    cum = ov.cumulative_cost(valid)
    total = valid.select(F.sum(F.col("cost").try_cast("decimal(38,10)"))).first()[0]
    assert cum.agg(F.max("cumulative")).first()[0] == total


def test_parts_per_session_sum(spark):
    parts = fx.fx_parts(spark, SF)
    summary = sessions.session_summary(fx.fx_sessions(spark, SF), parts)
    assert summary.agg(F.sum("nb_parts")).first()[0] == parts.where(F.col("session_id").isNotNull()).count()


def test_exploded_files_equal_list_sizes(spark):
    parts = fx.fx_parts(spark, SF)
    sizes = parts.where(F.col("part_type") == "patch").select(
        F.sum(F.size(F.from_json("files", "array<string>")))).first()[0]
    assert files.files_touched(parts).count() == sizes


def test_streaming_hourly_equals_batch_for_closed_hours(spark, scratch):
    root = scratch("inv-hourly")
    ev = fx.table(spark, SF, "events").select(F.col("ts").alias("timestamp"))
    ev.write.parquet(f"{root}/in")
    src = spark.readStream.schema(ev.schema).parquet(f"{root}/in")
    jobs.run(jobs.write_stream(jobs.stream_hourly(src), f"{root}/out", f"{root}/ckpt"))
    streamed = {r["hour"]: r["count"] for r in spark.read.parquet(f"{root}/out").collect()}
    batch = {r["hour"]: r["count"] for r in ov.hourly_activity(ev).collect()}
    assert streamed and all(batch[h] == n for h, n in streamed.items())
    assert len(batch) - len(streamed) <= 1  # only the still-open hour is held back
