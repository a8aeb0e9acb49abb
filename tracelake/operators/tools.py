"""Agent tool calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.scalars import blank_to, truncate
from tracelake.operators.timeline import OUTPUT_CHARS

# Fixed value: characters of the title shown with a call.
TITLE_CHARS = 50


def tool_parts(parts: DataFrame) -> DataFrame:
    """The tool parts."""
    return parts.where(F.col("part_type") == "tool")


def tool_names(parts: DataFrame) -> DataFrame:
    """Sorted distinct tool names, NULL left out."""
    return tool_parts(parts).select("tool").where(F.col("tool").isNotNull()).distinct().orderBy("tool")


def _restrict(df: DataFrame, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Keep rows whose ``column`` is in ``values`` (drops NULL).

    A list is an IN filter (pushed to the scan); a DataFrame of ids is a left
    semi join, whose strategy AQE picks from the measured size of the id side.
    """
    if isinstance(values, DataFrame):
        # Distinct ids first: partial aggregation shrinks the side before it moves.
        ids = values.select(F.col(values.columns[0]).alias(column)).where(F.col(column).isNotNull()).distinct()
        return df.join(ids, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))


def tool_calls(
    parts: DataFrame,
    tools: Sequence[str] | DataFrame = (),
    sessions: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """P5/O3: tool calls, oldest first.  An empty list means no filter (NULL
    values stay); a non-empty one keeps only listed values."""
    calls = tool_parts(parts)
    if isinstance(sessions, DataFrame) or len(sessions):
        calls = _restrict(calls, "session_id", sessions)
    if isinstance(tools, DataFrame) or len(tools):
        calls = _restrict(calls, "tool", tools)
    return calls.select(
        "part_id",
        "session_id",
        "time_created",
        blank_to("tool", "?").alias("tool"),
        truncate(F.coalesce(F.col("title"), F.lit("")), TITLE_CHARS).alias("title"),
        F.coalesce(F.col("tool_status"), F.lit("")).alias("tool_status"),
        "tool_input",
        truncate(F.coalesce(F.col("tool_output"), F.lit("")), OUTPUT_CHARS).alias("tool_output"),
    ).orderBy("time_created", "part_id")


def tool_call_count(parts: DataFrame, **filters) -> DataFrame:
    """The number of calls shown (one-row DataFrame)."""
    return tool_calls(parts, **filters).agg(F.count(F.lit(1)).alias("calls"))
