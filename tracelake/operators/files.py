"""Files modified by the agent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.scalars import epoch_ms, json_list


def files_touched(parts: DataFrame) -> DataFrame:
    """R2: one row per file listed by a patch part.

    Only a JSON array yields rows: bad JSON, objects, strings and ``null``
    give none (inner explode).
    """
    patches = parts.where(F.col("part_type") == "patch")
    return patches.select(
        "session_id",
        "title",
        "part_id",
        epoch_ms("time_created").alias("time_created"),
        F.explode(json_list(F.col("files"))).alias("file"),
    )


def files_per_title(files: DataFrame) -> DataFrame:
    """Modified files per session title (same titles merge, as in the
    original view), most first."""
    return (
        files.where(F.col("title").isNotNull())
        .groupBy("title")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "title")
    )


def files_per_session(files: DataFrame) -> DataFrame:
    """A6 by session id, for when titles repeat."""
    return (
        files.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "session_id")
    )


def hot_files(files: DataFrame, k: int | None = None, approx_distinct: bool = False) -> DataFrame:
    """Most-touched files: touches and distinct sessions per file
    (HyperLogLog with ``approx_distinct`` for very large inputs)."""
    distinct = F.approx_count_distinct("session_id") if approx_distinct else F.count_distinct("session_id")
    out = (
        files.where(F.col("file").isNotNull())
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("touches"), distinct.alias("sessions"))
        .orderBy(F.desc("touches"), "file")
    )
    return out.limit(k) if k else out


def files_total(files: DataFrame) -> DataFrame:
    """One row with the number of files touched, repeats counted
    (``files``) and not counted (``distinct_files``)."""
    return files.agg(F.count("file").alias("files"), F.count_distinct("file").alias("distinct_files"))
