"""The adapters reproduce the facts FIXTURES.md records for sf0.01."""

from decimal import Decimal

from pyspark.sql import functions as F

from tracelake import fixtures as fx
from tracelake.operators import overview as ov

SF = "/root/testdata/sf0.01"


def test_fx_logs_facts(spark):
    logs = fx.fx_logs(spark, SF)
    costs = logs.select(F.col("cost").try_cast("decimal(18,2)").alias("c")).where(F.col("c").isNotNull())
    assert costs.count() == 8912
    assert costs.agg(F.sum("c")).first()[0] == Decimal("444475.55")
    assert logs.select("level").distinct().count() == 5
    assert ov.hourly_activity(ov.valid_logs(logs)).count() == 720


def test_fx_source_facts(spark):
    parts = fx.fx_parts(spark, SF)
    assert parts.count() == 517
    assert parts.select("session_id").distinct().count() == 96
    by_type = {r["part_type"]: r["count"] for r in parts.groupBy("part_type").count().collect()}
    assert (by_type["patch"], by_type["reasoning"], by_type["step-finish"]) == (85, 84, 83)
    sessions = fx.fx_sessions(spark, SF)
    assert sessions.where(F.col("title") == "empty").count() == 3
