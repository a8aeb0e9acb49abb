"""Part counts by session and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def part_type_counts(parts: DataFrame, k: int | None = 50) -> DataFrame:
    """Parts per (session, type), most first; ties on the keys."""
    out = (
        parts.groupBy("session_id", "part_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "session_id", "part_type")
    )
    return out.limit(k) if k else out


def part_types(parts: DataFrame) -> DataFrame:
    """A7 by type only."""
    return parts.groupBy("part_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "part_type")
