"""Conversation store -> ``parts`` and ``sessions`` tables.

One lazy plan: filter (pushed to the scan) -> parse each part document once
into a VARIANT column and read its typed paths -> inner joins on ids with the
message role and session title.  No row passes through Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.schemas import PART_COLUMNS, SESSION_COLUMNS

_V = "_tl_doc"


def _get(path: str, typ: str = "string") -> Column:
    return F.try_variant_get(F.col(_V), path, typ)


def _json_text(path: str, missing: str) -> Column:
    """a JSON subtree as text; a missing path gives ``missing``."""
    return F.coalesce(F.to_json(F.try_variant_get(F.col(_V), path, "variant")), F.lit(missing))


def _text_or_json(path: str) -> Column:
    """A string value as is; any other JSON value as JSON text; null -> NULL."""
    sub = F.try_variant_get(F.col(_V), path, "variant")
    return F.when(sub.isNull() | F.is_variant_null(sub), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_variant_get(sub, "$", "string"), F.to_json(sub))
    )


def _source_sides(message: DataFrame, session: DataFrame, session_id: str | None):
    """(id, role) of each message and (id, title) of each session.  Each
    message document is parsed once, and only a short string moves."""
    m = message.select(
        F.col("id").alias("_tl_mid"),
        F.try_variant_get(F.try_parse_json(F.col("data")), "$.role", "string").alias("role"),
    )
    s = session.select(F.col("id").alias("_tl_sid"), F.col("title"))
    if session_id is not None:
        s = s.where(F.col("_tl_sid") == F.lit(session_id))
    return m, s


def join_source(
    part: DataFrame, message: DataFrame, session: DataFrame, session_id: str | None = None
) -> DataFrame:
    """J1 (+P2): inner join part -> message -> session, adding the message
    ``role`` and the session ``title`` to the part rows.

    Parts without a message or a session are dropped.  The session filter is
    applied to the part scan (and the session side) before anything else.
    The join strategy is left to Spark: AQE turns a side into a broadcast
    only when its measured size is under the broadcast threshold, otherwise
    it stays a sort-merge join (with skew splitting).
    """
    p = part
    if session_id is not None:
        p = p.where(F.col("session_id") == F.lit(session_id))
    m, s = _source_sides(message, session, session_id)
    return (
        p.join(m, p["message_id"] == m["_tl_mid"], "inner")
        .join(s, p["session_id"] == s["_tl_sid"], "inner")
        .drop("_tl_mid", "_tl_sid")
    )


def extract_fields(part: DataFrame) -> DataFrame:
    """Typed part columns from the part JSON (role and title, which
    come from the message and session, are not set here).

    Per part type: text/reasoning keep ``text`` (reasoning also its ``time``
    as JSON); tool keeps name, status, input (JSON) and output; step-finish
    keeps reason, tokens and cost; patch keeps its file list (JSON, ``[]``
    when missing).  Any other type keeps the common columns only.  A part
    whose JSON does not parse keeps its ids with NULL content (see
    ``part_rejects``).  Each document is parsed once into a VARIANT column.
    """
    docs = part.select(
        F.col("id").alias("part_id"),
        "message_id",
        "session_id",
        "time_created",
        "time_updated",
        F.try_parse_json(F.col("data")).alias(_V),
    )
    ptype = _get("$.type")
    is_ = lambda *types: ptype.isin(*types)
    null_s, null_l, null_d = (F.lit(None).cast(t) for t in ("string", "bigint", "double"))
    return docs.select(
        "part_id",
        "message_id",
        "session_id",
        "time_created",
        "time_updated",
        ptype.alias("part_type"),
        F.when(is_("text", "reasoning"), _get("$.text")).otherwise(null_s).alias("text"),
        F.when(is_("reasoning"), _json_text("$.time", "null")).otherwise(null_s).alias("reasoning_time"),
        F.when(is_("tool"), _get("$.tool")).otherwise(null_s).alias("tool"),
        F.when(is_("tool"), _get("$.state.status")).otherwise(null_s).alias("tool_status"),
        F.when(is_("tool"), _json_text("$.state.input", "null")).otherwise(null_s).alias("tool_input"),
        F.when(is_("tool"), _text_or_json("$.state.output")).otherwise(null_s).alias("tool_output"),
        F.when(is_("step-finish"), _get("$.reason")).otherwise(null_s).alias("reason"),
        F.when(is_("step-finish"), _get("$.tokens.input", "bigint")).otherwise(null_l).alias("tokens_input"),
        F.when(is_("step-finish"), _get("$.tokens.output", "bigint")).otherwise(null_l).alias("tokens_output"),
        F.when(is_("step-finish"), _get("$.tokens.total", "bigint")).otherwise(null_l).alias("tokens_total"),
        F.when(is_("step-finish"), _get("$.cost", "double")).otherwise(null_d).alias("cost"),
        F.when(is_("patch"), _json_text("$.files", "[]")).otherwise(null_s).alias("files"),
    )


def part_rejects(joined: DataFrame) -> DataFrame:
    """Parts whose JSON document does not parse (the original tool aborted
    the whole export on the first one)."""
    return joined.where(F.try_parse_json(F.col("data")).isNull()).select(
        F.col("id").alias("part_id"), "message_id", "session_id", "data"
    )


def sessions_table(session: DataFrame) -> DataFrame:
    """The fixed 11-column projection of the session table."""
    return session.select(*SESSION_COLUMNS)


def export_parts(
    part: DataFrame, message: DataFrame, session: DataFrame, session_id: str | None = None
) -> DataFrame:
    """J1 + F8-F10: the ``parts`` table, optionally for one session.

    The part documents are reduced to their typed columns first, then joined
    to the message role and session title: the joins move extracted columns,
    never whole JSON documents.
    """
    p = part.select("id", "message_id", "session_id", "time_created", "time_updated", "data")
    if session_id is not None:
        p = p.where(F.col("session_id") == F.lit(session_id))
    fields = extract_fields(p)
    m, s = _source_sides(message, session, session_id)
    joined = fields.join(m, fields["message_id"] == m["_tl_mid"], "inner").join(
        s, fields["session_id"] == s["_tl_sid"], "inner"
    )
    return joined.select(*PART_COLUMNS)
