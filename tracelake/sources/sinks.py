"""Sinks (S6, S7): full and per-session Parquet exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.plans.ordering import row_hash
from tracelake.session import shared_dir, shuffle_partitions

# Fixed value: rows a file of ``write_files``.
ROWS_PER_FILE = 100_000


def cluster_by_group(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Cluster rows on ``column`` for a ``partitionBy(column)`` write, with
    hot groups split.

    Rows per group are counted first (partial aggregation, written once; one
    scalar action reads the total).  A group is hot when it holds more than ``total / n``
    rows, so there are at most ``n`` hot groups: that table has a proven size
    bound and is broadcast.  Each hot group gets ``k = ceil(rows / (total /
    n))`` salts taken from a hash of the row's content (deterministic, so a
    retried task sends every row to the same place), then the rows are hash
    partitioned on (group, salt) into ``n`` partitions.  A group holding a
    third of the data is written by about n/3 tasks, a small group by one.
    """
    spark = df.sparkSession
    n = n or shuffle_partitions(spark)
    key = F.col(f"`{column}`")
    shared_dir(spark)
    # kept: both the total and the hot groups are read from it, the input is not
    counts = df.groupBy(key.alias("_tl_group")).agg(F.count(F.lit(1)).alias("_tl_rows")).checkpoint(eager=True)
    total = counts.agg(F.sum("_tl_rows")).first()[0] or 0
    share = max(1.0, total / n)
    hot = counts.where(F.col("_tl_rows") > share).select(
        "_tl_group", F.ceil(F.col("_tl_rows") / F.lit(share)).cast("int").alias("_tl_k")
    )
    content = row_hash(df)
    salted = df.join(F.broadcast(hot), key.eqNullSafe(F.col("_tl_group")), "left").withColumn(
        "_tl_salt", F.when(F.col("_tl_k").isNull(), F.lit(0)).otherwise(F.pmod(content, F.col("_tl_k")))
    )
    return salted.repartition(n, key, F.col("_tl_salt")).drop("_tl_group", "_tl_k", "_tl_salt")


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that are equal in ``columns`` side by side, for a ``partitionBy`` write,
    with the input evaluated once: Spark's rebalance hint shuffles on the columns,
    and AQE, which then knows the sizes, splits large partitions at the advisory
    size and joins small ones.  Without AQE it is a plain shuffle on the columns."""
    return df.hint("rebalance", *columns)


def export_session_buckets(df: DataFrame, path: str, buckets: int = 64, column: str = "session_id") -> str:
    """S7 for millions of sessions: ``of=<buckets>/bucket=<k>/`` folders by a hash of
    the session, each file sorted by session.

    The number of folders does not depend on the sessions, a bucket that grows large
    (one hot session, or the rows without one) becomes several files, and a reader
    of one session (``sources.tables.read_session``) opens its bucket alone, where
    the footers' ranges of sessions rule out most row groups.  One evaluation of
    the input, one shuffle."""
    key = F.col(f"`{column}`")
    out = df.withColumn("of", F.lit(int(buckets))).withColumn("bucket", session_bucket(key, F.lit(int(buckets))))
    out = rebalanced(out, "of", "bucket").sortWithinPartitions("bucket", key)
    out.write.mode("overwrite").partitionBy("of", "bucket").parquet(path)
    return path


def session_bucket(session: Column, buckets: Column) -> Column:
    """The bucket of a session: both sides of ``export_session_buckets`` use it."""
    return F.pmod(F.xxhash64(session), buckets).cast("int")


class EmptyExport(ValueError):
    """Raised when a per-session export would write nothing."""


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite ``path`` with ``df`` (write to a fresh load directory
    when other jobs may be reading the old one)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_files(df: DataFrame, path: str, rows: int = ROWS_PER_FILE) -> str:
    """A table in files of about ``rows`` rows, however many tasks made it: for
    readers whose cost goes by the file, as a stream that takes some files a batch.
    Counts the rows first; they are dealt out evenly, so no task writes more."""
    files = max(1, -(-df.count() // rows))
    df.repartition(files).write.mode("overwrite").parquet(path)
    return path


def export_session(df: DataFrame, session_id: str, path: str, column: str = "session_id") -> str:
    """One session's rows to their own location; an empty result is an
    error, as in the original exporter.  The emptiness test reads one row."""
    rows = df.where(F.col(f"`{column}`") == F.lit(session_id))
    if not rows.limit(1).count():
        raise EmptyExport(f"no rows for session {session_id!r}")
    rows.write.mode("overwrite").parquet(path)
    return path


def export_all_sessions(df: DataFrame, path: str, column: str = "session_id") -> str:
    """S7 at scale: every session's rows under ``column=<id>/`` in one job.

    Rows are clustered on the session first, so each task writes few
    directories; a session holding a large share of the rows is split over
    several tasks (several files in its directory), see ``cluster_by_group``.
    """
    out = cluster_by_group(df.where(F.col(f"`{column}`").isNotNull()), column)
    out.write.mode("overwrite").partitionBy(column).parquet(path)
    return path
