"""Log sources: text lines (S4) and multi-file Parquet by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.logparse import drop_blank, parse_log_lines
from tracelake.functions.scalars import utc_wall_clock
from tracelake.schemas import LOG_FIELDS
from tracelake.sources.mixed import ReadError, cannot_merge, read_mixed


def read_log_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text log lines (one row per physical line), blank lines dropped,
    with the source file in ``filename``."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("filename"))
    return drop_blank(lines)


def read_text_logs(
    spark: SparkSession, path: str | Sequence[str], session_id: str | None = None, strict: bool = True
) -> DataFrame:
    """S4 + F1 + F2 + P3: parsed ``logs`` rows from text log files."""
    return parse_log_lines(read_log_lines(spark, path), session_id=session_id, strict=strict)


def _to_logs_schema(df: DataFrame) -> DataFrame:
    """Align one frame to the ``logs`` schema: known fields cast (timestamp
    parsed leniently, the rest as text), missing ones NULL, other columns
    folded into ``extras``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = set(types)
    known = set(LOG_FIELDS) | {"filename", "extras"}
    out = []
    for name in LOG_FIELDS:
        c = F.col(f"`{name}`") if name in cols else F.lit(None)
        if name == "timestamp":
            out.append(utc_wall_clock(c, types.get(name, T.StringType())).alias(name))
        else:
            out.append(c.cast("string").alias(name))
    out.append(F.col("_metadata.file_path").alias("filename"))
    others = sorted(cols - known)
    extras = (
        F.map_filter(
            F.map_from_arrays(
                F.array(*[F.lit(o) for o in others]), F.array(*[F.col(f"`{o}`").cast("string") for o in others])
            ),
            lambda k, v: v.isNotNull(),
        )
        if others
        else F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    )
    out.append(extras.alias("extras"))
    return df.select(*out)


def read_logs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Several Parquet log files as one ``logs`` table, columns
    matched by name, absent ones NULL, plus the source file name.

    When all files agree on types, one scan with ``mergeSchema`` does it.
    When they do not (an int here, a string there), the files are grouped by
    the types in their footers, each group is one scan cast to the ``logs``
    schema, and the groups are united by name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    try:
        return _to_logs_schema(spark.read.option("mergeSchema", "true").parquet(*paths))
    except ReadError as e:
        if not cannot_merge(e):
            raise
    return read_mixed(spark, paths, _to_logs_schema)
