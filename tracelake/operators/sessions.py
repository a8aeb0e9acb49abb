"""Per-session results over ``parts`` and ``sessions``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.scalars import epoch_ms, session_label, typed_decimal, utc_wall_clock
from tracelake.plans.asof import as_of_join

MONEY = "decimal(38,10)"


def _money_sum(df: DataFrame, c: str) -> F.Column:
    """Exact sum of a number (text parsed leniently); no value sums to 0."""
    return F.coalesce(F.sum(typed_decimal(c, df.schema[c].dataType)), F.lit(0).cast(MONEY))


def session_metrics(parts: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """A5/A10: per session, parts (non-NULL ids), tool calls, distinct
    messages, cost and token sums.  NULL sessions are left out.

    All aggregates are algebraic except the distinct message count, which
    Spark expands on (session, message) with partial aggregation, so a very
    long session does not land whole in one buffer.  ``approx_distinct``
    switches to HyperLogLog for very large inputs.
    """
    distinct = (
        F.approx_count_distinct("message_id") if approx_distinct else F.count_distinct("message_id")
    )
    return (
        parts.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count("part_id").alias("nb_parts"),
            F.count("tool").alias("nb_tools"),
            distinct.alias("nb_messages"),
            _money_sum(parts, "cost").alias("cost"),
            F.coalesce(
                F.sum(typed_decimal("tokens_total", parts.schema["tokens_total"].dataType, 38, 0)),
                F.lit(0).cast("decimal(38,0)"),
            ).alias("tokens"),
        )
    )


def session_summary(sessions: DataFrame, parts: DataFrame) -> DataFrame:
    """Every session with its metrics (NULL when it has no part),
    newest first, NULL times last."""
    metrics = session_metrics(parts)
    base = sessions.select(
        "id", "title", epoch_ms("time_created").alias("dt"), "summary_additions", "summary_deletions"
    )
    return (
        base.join(metrics, base["id"] == metrics["session_id"], "left")
        .drop("session_id")
        .orderBy(F.desc_nulls_last("dt"), "id")
    )


def session_list(sessions: DataFrame) -> DataFrame:
    """Sessions newest first with a display label."""
    return sessions.select(
        "id",
        session_label("title", "id").alias("label"),
        epoch_ms("time_created").alias("dt"),
        "time_created",
    ).orderBy(F.desc("time_created"), "id")


def cost_per_message(parts: DataFrame) -> DataFrame:
    """One cost and token figure per (session, message)."""
    return (
        parts.where(F.col("session_id").isNotNull() & F.col("message_id").isNotNull())
        .groupBy("session_id", "message_id")
        .agg(
            F.count("part_id").alias("nb_parts"),
            _money_sum(parts, "cost").alias("cost"),
            F.coalesce(F.sum("tokens_total"), F.lit(0).cast("bigint")).alias("tokens"),
        )
    )


def logs_by_session(logs: DataFrame, sessions: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Relate log events to conversations.

    Per session id: log event count (both sides pre-aggregated before the
    join, so a session with a huge log never meets its rows one by one),
    the session title, and its part count when ``parts`` is given.  Sessions
    known to one side only, ``parts`` included, are kept (full outer join on pre-aggregated keys).
    """
    log_counts = (
        logs.where(F.col("`session.id`").isNotNull())
        .groupBy(F.col("`session.id`").alias("session_id"))
        .agg(F.count(F.lit(1)).alias("log_events"))
    )
    s = sessions.select(F.col("id").alias("session_id"), "title")
    out = s.join(log_counts, "session_id", "full_outer")
    if parts is not None:
        known = parts.where(F.col("session_id").isNotNull())
        pc = known.groupBy("session_id").agg(F.count("part_id").alias("nb_parts"))
        out = out.join(pc, "session_id", "full_outer")
    return out


def logs_in_progress(logs: DataFrame, parts: DataFrame, time: str = "timestamp", session: str = "session.id") -> DataFrame:
    """X8 by event: every log event with the part, and its message, that its
    session was at: the newest one created at or before the event (``part_id,
    message_id, part_type, part_created``; NULL before the first part, and for
    events without a session or time).  Of parts created at the same moment the one
    with the greatest id.  A session of any size is split (``plans.asof``)."""
    at = utc_wall_clock(F.col(f"`{time}`"), logs.schema[time].dataType)
    states = parts.select(
        F.col("session_id").alias("_tl_session"), epoch_ms("time_created").alias("part_created"),
        "part_id", "message_id", "part_type",
    )
    return as_of_join(
        logs, states, F.col(f"`{session}`"), at, "_tl_session", "part_created",
        ["part_id", "message_id", "part_type", "part_created"],
    )
