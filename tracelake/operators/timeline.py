"""Conversation timeline (O2, F12-F14, F16): parts as display rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.scalars import blank_to, json_list, number_text, truncate

# Display limits (characters) and the default number of parts.
REASONING_CHARS = 2000
OUTPUT_CHARS = 4000
DEFAULT_N = 200


def classify(parts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``kind`` and ``body`` of each part; unknown types get NULL kind."""
    pt, role = F.col("part_type"), F.col("role")
    kind = (
        F.when((pt == "text") & (role == "user"), "user")
        .when(pt == "text", "assistant")
        .when(pt == "reasoning", "reasoning")
        .when(pt == "tool", "tool")
        .when(pt == "step-finish", "step-finish")
        .when(pt == "patch", "patch")
        .when(pt == "step-start", "step-start")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    cost = F.col("cost").cast("string")
    if parts.schema["cost"].dataType.typeName() == "double":
        cost = number_text("cost")
    dash = lambda c: F.coalesce(c, F.lit("-"))
    body: Column = (
        F.when(pt == "text", text)
        .when(pt == "reasoning", truncate(text, REASONING_CHARS))
        .when(pt == "tool", F.concat(blank_to("tool", "?"), F.lit(" · "), F.coalesce(F.col("tool_status"), F.lit(""))))
        .when(pt == "step-finish", F.concat(dash(F.col("tokens_total").cast("string")), F.lit(" tokens · "), dash(cost)))
        .when(pt == "patch", F.coalesce(F.array_join(json_list(F.col("files")), ", "), F.lit("")))
        .when(pt == "step-start", F.lit(""))
    )
    return parts.select(
        "session_id",
        "part_id",
        *keep,
        "time_created",
        kind.alias("kind"),
        body.alias("body"),
        F.when(pt == "tool", F.col("tool_input")).alias("tool_input"),
        F.when(pt == "tool", truncate(F.coalesce(F.col("tool_output"), F.lit("")), OUTPUT_CHARS)).alias("tool_output"),
    )


def timeline(parts: DataFrame, session_id: str, n: int = DEFAULT_N) -> DataFrame:
    """O2: one session's first ``n`` parts, oldest first, as display rows.

    As in the original view, parts of unknown type take a slot but are not
    shown.
    """
    first = parts.where(F.col("session_id") == F.lit(session_id)).orderBy("time_created", "part_id").limit(n)
    return classify(first).where(F.col("kind").isNotNull()).orderBy("time_created", "part_id")


def timelines(parts: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """O2 for every session at once: the first ``n`` parts of each, with
    their position ``seq`` in the session.

    ``row_number() <= n`` per session plans as a window group limit, which
    Spark also applies before the shuffle, so a huge session sends only
    ``n`` rows per map task.
    """
    w = Window.partitionBy("session_id").orderBy("time_created", "part_id")
    first = parts.withColumn("seq", F.row_number().over(w).cast("bigint")).where(F.col("seq") <= n)
    return classify(first, keep=("seq",)).where(F.col("kind").isNotNull())
