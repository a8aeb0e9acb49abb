"""Parquet table sources."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tracelake.schemas import PARTS, SESSIONS, SOURCE_MESSAGE, SOURCE_PART, conform
from tracelake.sources.mixed import ReadError, cannot_merge, read_mixed
from tracelake.sources.sinks import session_bucket


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """While a table of many folders is opened: they are listed by four tasks a
    core.  Spark's own default is a task for each folder up to 10,000, which list no
    more at a time and cost more than the listing.  A set value is kept."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(key)


def _read_conformed(spark: SparkSession, path: str, schema, merge: bool) -> DataFrame:
    """Read Parquet written by any exporter and conform it to ``schema`` by
    name.  Files of one table may disagree on types (a pandas writer turns an
    integer column with gaps into float): with ``merge`` the merged file
    schema is read (footers of all files, merged by a Spark job when there
    are many) and cast, and files that cannot be merged are read in groups of
    like types; without it the fixed schema is imposed on the scan."""
    if not merge:
        with few_listing_tasks(spark):
            raw = spark.read.schema(schema).option("basePath", path).parquet(path)
        return conform(raw, schema)
    try:
        return conform(spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path), schema)
    except ReadError as e:
        if not cannot_merge(e):
            raise
    return read_mixed(spark, [path], lambda raw: conform(raw, schema), base=path)


def read_parts(spark: SparkSession, path: str, merge: bool = True) -> DataFrame:
    """The ``parts`` table with its fixed schema (missing columns NULL;
    ``session_id`` partitions, if any, are read back as a column)."""
    return _read_conformed(spark, path, PARTS, merge)


def read_sessions(spark: SparkSession, path: str, merge: bool = True) -> DataFrame:
    return _read_conformed(spark, path, SESSIONS, merge)


def read_session(spark: SparkSession, path: str, session_id: str, schema=PARTS, column: str = "session_id") -> DataFrame:
    """One session of a table written by ``sinks.export_session_buckets``: only the
    folders of its bucket are listed and read (also where exports with several
    numbers of buckets lie side by side)."""
    stored = StructType([*schema.fields, StructField("of", IntegerType()), StructField("bucket", IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    own = F.col("bucket") == session_bucket(F.lit(session_id), F.col("of"))
    return rows.where(own & (F.col(f"`{column}`") == F.lit(session_id))).drop("of", "bucket")


def read_source(
    spark: SparkSession, root: str | None = None, jdbc_url: str | None = None, jdbc_props: dict | None = None,
    partitions: int = 16,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ``part``, ``message`` and ``session`` tables of a conversation
    store, from Parquet directories under ``root`` or over JDBC (when a
    driver jar is on the class path; reads are split on ``time_created``)."""
    if jdbc_url:
        props = dict(jdbc_props or {})

        def jdbc(table: str, split: str | None) -> DataFrame:
            if not split:
                return spark.read.jdbc(jdbc_url, table, properties=props)
            bounds = spark.read.jdbc(
                jdbc_url, f"(SELECT min({split}) lo, max({split}) hi FROM {table}) b", properties=props
            ).first()
            return spark.read.jdbc(
                jdbc_url, table, column=split, lowerBound=int(bounds["lo"] or 0),
                upperBound=int(bounds["hi"] or 0) + 1, numPartitions=partitions, properties=props,
            )

        return jdbc("part", "time_created"), jdbc("message", None), jdbc("session", None)
    root = root.rstrip("/")
    part = spark.read.schema(SOURCE_PART).parquet(f"{root}/part")
    message = spark.read.schema(SOURCE_MESSAGE).parquet(f"{root}/message")
    session = spark.read.schema(SESSIONS).parquet(f"{root}/session")
    return part, message, session


def list_parquet(spark: SparkSession, root: str) -> DataFrame:
    """S3: every ``.parquet`` object under ``root`` (recursively), with its
    size, modification time and kind, routed by the first path segment:
    ``conversations/`` and ``sessions/`` are named, everything else is a log.

    The binary-file source lists the files (in parallel when there are many
    directories); ``content`` is never selected, so no file body is read.
    """
    base = root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length", "modificationTime")
    )
    # The key is the path below ``root`` (the scheme and prefix differ by file system).
    anchor = base.split(":", 1)[-1].lstrip("/")
    at = F.instr(F.col("path"), anchor)
    rel = F.when(at > 0, F.expr(f"substring(path, instr(path, '{anchor}') + {len(anchor) + 1})")).otherwise(
        F.col("path")
    )
    kind = (
        F.when(rel.startswith("conversations/"), "conversations")
        .when(rel.startswith("sessions/"), "sessions")
        .otherwise("logs")
    )
    return files.select(
        "path", rel.alias("key"), "length",
        F.col("modificationTime").alias("modified"), kind.alias("kind"),
    ).orderBy("key")



def count_parquet(spark: SparkSession, root: str) -> DataFrame:
    """S3 with rows: the listing of ``list_parquet`` and the number of rows in each
    file.  One scan over all files, whatever their schemas: it asks for a column that
    no file has, so only footers are read."""
    files = spark.read.schema("_tl_none int").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    rows = files.parquet(root.rstrip("/")).select(F.col("_metadata.file_path").alias("_tl_path"))
    rows = rows.groupBy("_tl_path").agg(F.count(F.lit(1)).alias("rows"))
    listed = list_parquet(spark, root)
    return (
        listed.join(rows, F.url_decode(listed["path"]) == F.url_decode(rows["_tl_path"]), "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint"))).drop("_tl_path")
    )
