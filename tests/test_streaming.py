"""T1-T4 on scratch folders."""

import datetime as dt

from tracelake.plans.tables import latest
from tracelake.streaming import jobs


def test_hourly_watermark_drops_late_rows_and_holds_open_window(spark, scratch):
    root = scratch("hourly")
    schema = "timestamp timestamp_ntz, n int"
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 5), 1), (dt.datetime(2024, 1, 1, 12, 30), 2)], schema) \
        .coalesce(1).write.parquet(f"{root}/in/b1")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    jobs.run(jobs.write_stream(jobs.stream_hourly(src), f"{root}/out", f"{root}/ckpt"))
    first = {str(r["hour"]): r["count"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert first == {"2024-01-01 10:00:00": 1}  # 12:00 is still open
    # A row older than the watermark (12:20) is dropped; a newer one closes 12:00.
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 10), 3), (dt.datetime(2024, 1, 1, 14, 0), 4)], schema) \
        .coalesce(1).write.parquet(f"{root}/in/b2")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    jobs.run(jobs.write_stream(jobs.stream_hourly(src), f"{root}/out", f"{root}/ckpt"))
    after = {str(r["hour"]): r["count"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert after == {"2024-01-01 10:00:00": 1, "2024-01-01 12:00:00": 1}


def test_ingest_only_new_files(spark, scratch):
    root = scratch("ingest")
    spark.createDataFrame([("timestamp=2024-01-01T00:00:00 level=a",)], "value string").write.text(f"{root}/in/1")
    jobs.run(jobs.stream_logs(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    spark.createDataFrame([("timestamp=bad level=b",), ("",)], "value string").write.text(f"{root}/in/2")
    jobs.run(jobs.stream_logs(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    rows = sorted((r["level"], r["timestamp"]) for r in spark.read.parquet(f"{root}/out").collect())
    assert rows == [("a", dt.datetime(2024, 1, 1)), ("b", None)]


def test_dedup_within_watermark(spark, scratch):
    root = scratch("dedup")
    schema = "part_id string, dt timestamp_ntz, v int"
    rows = [("p1", dt.datetime(2024, 1, 1), 1), ("p1", dt.datetime(2024, 1, 1), 2), ("p2", dt.datetime(2024, 1, 2), 3)]
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/a")
    spark.createDataFrame(rows[:1], schema).write.parquet(f"{root}/in/b")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    jobs.run(jobs.write_stream(jobs.stream_dedup(jobs.with_arrival(src)), f"{root}/out", f"{root}/ckpt"))
    assert sorted(r["part_id"] for r in spark.read.parquet(f"{root}/out").collect()) == ["p1", "p2"]


def test_dedup_query_takes_few_batches_of_an_input_in_many_files(spark, scratch, monkeypatch):
    import os

    from tracelake import queries

    sf, root = scratch("sf"), scratch("dedup-query")
    rows = [(c, t, "user", f"text {c} {t}") for c in range(1, 31) for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns.repartition(40).write.parquet(f"{sf}/conversations.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: root)
    monkeypatch.setattr(queries.fx, "fx_parts", lambda s, d, f=queries.fx.fx_parts: f(s, d).repartition(40))
    got = [r["part_id"] for r in queries.q_stream_dedup(spark, sf).collect()]
    assert sorted(got) == sorted(f"p{c}-{t}" for c, t, _, _ in rows)
    batches = [n for n in os.listdir(f"{root.removeprefix('file:')}/ckpt/commits") if n.isdigit()]
    assert len(batches) <= 4  # a file of each load, not one of each task, and one without rows


def test_files_by_rows(spark, scratch):
    from tracelake.sources import sinks

    df = spark.range(1000).repartition(20)
    for rows, files in ((1000, 1), (999, 2), (300, 4)):
        path = sinks.write_files(df, scratch("files"), rows=rows)
        back = spark.read.parquet(path)
        assert back.count() == 1000 and len(back.inputFiles()) == files
    assert spark.read.parquet(sinks.write_files(df.limit(0), scratch("files"))).count() == 0


def test_changelog_then_latest(spark, scratch):
    from tracelake.schemas import PARTS

    root = scratch("changelog")
    empty = {c: None for c in PARTS.fieldNames()}

    def row(pid, tu, text):
        d = dict(empty, part_id=pid, time_created=0, time_updated=tu, text=text)
        return tuple(d[c] for c in PARTS.fieldNames())

    spark.createDataFrame([row("a", 1, "a1"), row("b", 1, "b1")], PARTS).write.parquet(f"{root}/in/load=0")
    jobs.run(jobs.stream_changelog(spark, f"{root}/in", f"{root}/log", f"{root}/ckpt"))
    spark.createDataFrame([row("a", 2, "a2")], PARTS).write.parquet(f"{root}/in/load=1")
    jobs.run(jobs.stream_changelog(spark, f"{root}/in", f"{root}/log", f"{root}/ckpt"))
    log = spark.read.parquet(f"{root}/log")
    assert log.count() == 3 and sorted(r["load_id"] for r in log.collect()) == [0, 0, 1]
    now = {r["part_id"]: r["text"] for r in latest(log, "part_id", ["time_updated", "load_id"]).collect()}
    assert now == {"a": "a2", "b": "b1"}
