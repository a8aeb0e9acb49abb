"""Stored tables: create-once, loads, history, as-of reads.

Plain Parquet has no snapshots and no MERGE, so a versioned table is kept as
an append-only set of loads: ``<table>/load_id=<n>/``.  Every load adds the
rows it received (inserts and new versions of existing keys); a reader picks
the newest version of each key.  Nothing ever overwrites the directory being
read.  A table format with snapshots and MERGE can replace this layout; the
function signatures stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.scalars import epoch_ms
from tracelake.sources.sinks import rebalanced

LOAD = "load_id"


# --------------------------------------------------------------- catalog


def create_table_once(
    spark: SparkSession,
    db: str,
    name: str,
    df: DataFrame,
    fmt: str = "parquet",
    location: str | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> int:
    """Create the namespace if absent, then create the table from
    ``df`` only if it does not exist yet; a second run is a no-op.  Returns
    the table's row count.

    ``bucket_by=(column, n)`` stores the table in ``n`` buckets on
    ``column`` (e.g. parts on ``session_id``): later aggregations and joins
    on that column read co-located buckets and skip the shuffle.

    When this call writes the table, the count comes from ``observe()``
    metrics collected by the write job itself (no second scan).  When the
    table already exists (or another writer created it first), nothing is
    written and the existing table is counted.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")
    full = f"`{db}`.`{name}`"
    if not spark.catalog.tableExists(full):
        obs = Observation(f"tl_ctas_{uuid.uuid4().hex}")
        try:
            writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("errorifexists")
            if bucket_by:
                column, n = bucket_by
                writer = writer.bucketBy(int(n), column).sortBy(column)
            writer.saveAsTable(full)
            return int(obs.get["rows"])
        except AnalysisException:
            if not spark.catalog.tableExists(full):
                raise
    return spark.table(full).count()


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Table names of a namespace; an empty frame when listing fails."""
    try:
        shown = spark.sql(f"SHOW TABLES IN `{db}`")
        return shown.where(~F.col("isTemporary")).select(F.col("tableName").alias("table"))
    except Exception:
        return spark.createDataFrame([], "table string")


# ----------------------------------------------------------------- X1


def latest(df: DataFrame, key: str | Sequence[str] = "part_id", order: Sequence[str] = ("time_updated",)) -> DataFrame:
    """The newest version of each key (greatest ``order``).

    ``max_by`` over a struct of all columns is an aggregate with map-side
    partial aggregation: each task keeps one row per key before the shuffle,
    so a key with millions of versions never lands whole in one task.
    Versions equal in ``order`` are interchangeable; one of them is kept.
    Rows with a NULL in the key are versions of nothing: all are kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    nameless = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    rows, df = df, df.where(~nameless)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order]))
    newest = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best.alias("_tl_row")).select(
        *[F.col(f"`{k}`") for k in keys], *[F.col("_tl_row")[c].alias(c) for c in rest]
    )
    return newest.select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(rows.where(nameless))


# ------------------------------------------------------------ X2 / X3


def upsert(table_dir: str, new_rows: DataFrame, load_id: int) -> str:
    """Add one load to the table: the new rows (inserts and updates)
    under ``load_id=<n>``, stamped with the load time.

    Only that load's directory is written, in overwrite mode: re-running a
    load (after a failure, or twice) replaces it instead of duplicating rows,
    and older loads are never touched.  ``new_rows`` must not be read from
    the same load directory."""
    (
        new_rows.withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
        .write.mode("overwrite")
        .parquet(f"{table_dir.rstrip('/')}/{LOAD}={int(load_id)}")
    )
    return table_dir


def unseen(stored: DataFrame, rows: DataFrame, key: str = "part_id", order: Sequence[str] = ("time_updated",)) -> DataFrame:
    """The rows of ``rows`` that ``stored`` lacks: by key, the newest of a repeated
    one; rows without a key by their whole content, each once.

    The stored side is read for its keys alone.  They are first reduced to the keys
    of ``rows`` by a semi join, into which Spark can push a runtime Bloom filter of
    the new keys, so that most stored keys go before the shuffle; the anti join
    then meets keys that are known to be repeated.  ``rows`` is evaluated more than
    once: pass a stored or checkpointed frame."""
    k = F.col(f"`{key}`")
    named = latest(rows.where(k.isNotNull()), key, order)
    new = rows.where(k.isNotNull()).select(k).distinct()
    seen = stored.where(k.isNotNull()).select(k).join(new, key, "left_semi").distinct()
    fresh = named.join(seen, key, "left_anti")
    nameless = rows.where(k.isNull()).distinct().alias("n")
    names = [c for c in rows.columns if c in stored.columns]
    held = stored.where(k.isNull()).select(*[F.col(f"`{c}`") for c in names]).alias("s")
    same = reduce(and_, [F.col(f"n.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in names])
    for c in rows.columns:
        if c not in names:  # a column that no stored row has: only NULL is equal
            same = same & F.col(f"n.`{c}`").isNull()
    return fresh.unionByName(nameless.join(held, same, "left_anti"))


def insert_only(
    table_dir: str,
    new_rows: DataFrame,
    load_id: int,
    key: str = "part_id",
    order: Sequence[str] = ("time_updated",),
    schema: T.StructType | None = None,
) -> int:
    """X2, insert-only: add one load with the rows that no other load holds
    (``unseen``); stored rows are never given a new version.  Returns the number of
    rows added.

    A rerun under the same number replaces the load, under another one adds nothing:
    keys are looked up in all loads but this one, whose folder is left out by its
    partition value.  Rows without a key count as held when an equal row is."""
    spark = new_rows.sparkSession
    try:
        others = read_loads(spark, table_dir, schema).where(F.col(LOAD) != int(load_id))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        others = new_rows.limit(0)  # the first load
    added = Observation(f"tl_insert_{uuid.uuid4().hex}")
    rows = unseen(others, new_rows, key, order).observe(added, F.count(F.lit(1)).alias("rows"))
    upsert(table_dir, rows, load_id)
    return int(added.get["rows"])


def read_loads(spark: SparkSession, table_dir: str, schema: T.StructType | None = None) -> DataFrame:
    """All loads of a table.  Without a ``schema`` the files' schemas are
    merged, so a column that only some loads have is read (NULL elsewhere)."""
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(
            T.StructType(
                [*schema.fields, T.StructField("loaded_at", T.TimestampNTZType()), T.StructField(LOAD, T.IntegerType())]
            )
        )
    return reader.parquet(table_dir)


def as_of(
    spark: SparkSession,
    table_dir: str,
    load_id: int | None = None,
    key: str = "part_id",
    order: Sequence[str] = ("time_updated",),
    schema: T.StructType | None = None,
) -> DataFrame:
    """The table as it was after load ``load_id`` (latest when None).

    The load filter is on the partition column, so only the wanted load
    directories are listed and read; then X1 keeps the newest version, with
    the load number breaking ties on ``order``.
    """
    rows = read_loads(spark, table_dir, schema)
    if load_id is not None:
        rows = rows.where(F.col(LOAD) <= load_id)
    current = latest(rows, key, [*order, LOAD])
    return current.drop("loaded_at", LOAD)


def as_of_time(
    spark: SparkSession,
    table_dir: str,
    when,
    key: str = "part_id",
    order: Sequence[str] = ("time_updated",),
    schema: T.StructType | None = None,
) -> DataFrame:
    """X3 by time: the table as it was at ``when`` (loads committed at or
    before it), the newest version of each key."""
    rows = read_loads(spark, table_dir, schema).where(F.col("loaded_at") <= F.lit(when).cast("timestamp_ntz"))
    return latest(rows, key, [*order, LOAD]).drop("loaded_at", LOAD)


def load_history(spark: SparkSession, table_dir: str, key: str = "part_id") -> DataFrame:
    """One row per load: commit time, operation, rows, inserts (keys
    seen for the first time in that load) and updates (all other rows).

    Two partial aggregations and a join of two per-load tables (as many rows
    as there are loads): no row is shuffled back to its key.
    """
    rows = read_loads(spark, table_dir).select(key, LOAD, "loaded_at")
    per_load = rows.groupBy(LOAD).agg(
        F.min("loaded_at").alias("committed_at"), F.count(F.lit(1)).alias("rows")
    )
    firsts = (
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(LOAD).alias(LOAD))
        .groupBy(LOAD).agg(F.count(F.lit(1)).alias("inserts"))
    )
    hist = per_load.join(firsts, LOAD, "left").select(
        LOAD, "committed_at", "rows", F.coalesce(F.col("inserts"), F.lit(0).cast("bigint")).alias("inserts")
    ).withColumn("updates", F.col("rows") - F.col("inserts"))
    op = F.when(F.col("updates") == 0, "append").otherwise("upsert")
    return hist.select(LOAD, "committed_at", op.alias("operation"), "rows", "inserts", "updates").orderBy(LOAD)


def compact(spark: SparkSession, table_dir: str, new_dir: str, key: str = "part_id",
            order: Sequence[str] = ("time_updated",)) -> str:
    """Write the current state of a load table as load 0 of a new table, so
    reads stop growing with history."""
    upsert(new_dir, as_of(spark, table_dir, None, key, order), 0)
    return new_dir


# ------------------------------------------------------------ X4 / X5


def month_of(ms: Column | str) -> Column:
    """``yyyy-MM`` of an epoch-milliseconds column, in UTC."""
    return F.substring(epoch_ms(ms).cast("string"), 1, 7)


def write_partitioned(df: DataFrame, path: str, by: str = "month", time_col: str = "time_created") -> str:
    """Write with one directory per month (or any column ``by``).

    Rows are put side by side by the partition value first, a large month split
    over several tasks (``rebalanced``), so each task writes few files; the input
    is evaluated once.  Readers filtering on ``by`` read only the matching
    directories.
    """
    out = df if by in df.columns else df.withColumn(by, month_of(time_col))
    rebalanced(out, by).write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def read_evolved(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Read files written under older schemas with today's schema:
    columns they lack come back NULL, narrower integers are widened."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).parquet(*paths)
