"""Structured Streaming jobs that keep the tables fresh.

All sinks are files with a checkpoint (exactly-once, restartable after a lost
executor or driver); no ``foreachBatch`` callback, no memory sink.  ``run``
drives a query with ``availableNow``: it processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracelake.functions.logparse import drop_blank, parse_log_lines
from tracelake.functions.scalars import epoch_ms, hour_floor
from tracelake.schemas import PARTS


def run(query: StreamingQuery, timeout_s: int | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query, as long as it takes unless the
    caller gives a limit; surface its failure."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception():
        raise query.exception()
    return query


# Fixed value: files per micro-batch.  ``availableNow`` still drains all that is
# there, but a large backfill is cut into bounded batches.
MAX_FILES_PER_BATCH = 1000


def stream_logs(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH
) -> StreamingQuery:
    """New log text files only -> parsed ``logs`` rows -> Parquet.

    The timestamp is parsed leniently here: a bad line must not stop the
    stream; it lands with a NULL time.
    """
    lines = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .text(in_dir)
        .select("value", F.col("_metadata.file_path").alias("filename"))
    )
    logs = parse_log_lines(drop_blank(lines), strict=False)
    return (
        logs.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_hourly(events: DataFrame, ts: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """Events per hour on a stream.  Rows later than the watermark are
    dropped; in append mode an hour is emitted once the watermark passes its
    end.  The watermark needs a zoned timestamp, so a ``timestamp_ntz``
    column is cast first (session time zone UTC)."""
    col = F.col(f"`{ts}`").cast("timestamp")
    timed = events.withColumn("_tl_ts", col).withWatermark("_tl_ts", delay)
    return timed.groupBy(F.window("_tl_ts", "1 hour")).agg(F.count(F.lit(1)).alias("count")).select(
        F.col("window.start").cast("timestamp_ntz").alias("hour"), "count"
    )


def stream_hourly_partial(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """T2 with late rows: partial counts per hour, many rows for an hour, for
    ``read_hourly`` to add up.

    Counting within an Arrow batch needs no state and no watermark, so a row counts
    whenever it arrives and no hour is ever held open; a batch of some 10,000 rows
    becomes one row per hour in it.  Rows without a time are left out."""

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            counts = batch.column(0).value_counts()
            hours, n = counts.field("values"), counts.field("counts")
            yield pa.RecordBatch.from_arrays([hours, n.cast(pa.int64())], names=["hour", "count"])

    timed = events.select(hour_floor(F.col(f"`{ts}`").cast("timestamp_ntz")).alias("hour"))
    return timed.where(F.col("hour").isNotNull()).mapInArrow(count, "hour timestamp_ntz, count long")


def read_hourly(spark: SparkSession, out_dir: str, delay: str = "10 minutes") -> DataFrame:
    """The hours of ``stream_hourly_partial`` so far: ``hour, count, settled``.  An
    hour is settled once one that starts ``delay`` or more after its end has been
    seen; later rows still add to it."""
    hours = spark.read.schema("hour timestamp_ntz, count long").parquet(out_dir).groupBy("hour").agg(F.sum("count").alias("count"))
    newest = hours.agg(F.max("hour")).first()[0]
    end = F.col("hour") + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {delay}")
    return hours.select("hour", "count", (F.lit(newest) >= end).alias("settled"))


def with_arrival(files: DataFrame) -> DataFrame:
    """A stream of files with ``arrived``, the time each file was written: it
    only moves on, whatever times the rows hold."""
    return files.withColumn("arrived", F.col("_metadata.file_modification_time"))


def stream_dedup(parts: DataFrame, key: str = "part_id", arrived: str = "arrived", delay: str = "1 day") -> DataFrame:
    """Drop repeated exports of the same part that arrive within ``delay``
    of one another.  The watermark follows the time of arrival, so a part that
    was never seen is kept however old it is."""
    timed = parts.withColumn("_tl_ts", F.col(arrived).cast("timestamp")).withWatermark("_tl_ts", delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_tl_ts", arrived)


def stream_changelog(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_files: int = MAX_FILES_PER_BATCH
) -> StreamingQuery:
    """T4: append every exported version of ``parts`` to a change log, with
    the load it came from (``load=<n>`` in the file path) and its time.
    Readers take the newest version per part (``plans.tables.latest``)."""
    src = (
        spark.readStream.schema(PARTS)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .parquet(in_dir)
    )
    load = F.regexp_extract(F.col("_metadata.file_path"), r"load=(\d+)", 1).cast("int")
    out = src.withColumn("load_id", load).withColumn("dt", epoch_ms("time_created"))
    return (
        out.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(df: DataFrame, out_dir: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Any stream to Parquet files (append mode, the only file-sink mode)."""
    return (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
