"""Oracle SQL (DuckDB dialect) for the proof queries.

The driver's tables are views named like the parquet files.  The CTEs repeat
the adapter formulas of ``tracelake.fixtures``; everything after them is an
independent formulation of each operator's semantics.
"""

from __future__ import annotations

FX_LOGS = """
fx_logs AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
         NULLIF(event_type, 'view') AS level,
         'event' AS type,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE 's' || CAST(user_id AS VARCHAR) END AS "session.id",
         CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE CAST(event_id % 50 AS VARCHAR) END AS "tokens.input",
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 70 AS VARCHAR) END AS "tokens.output",
         CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 29 = 0 THEN NULL
              ELSE CAST(value AS VARCHAR) END AS cost
  FROM events
),
valid AS (
  SELECT TRY_CAST("timestamp" AS TIMESTAMP) AS "timestamp", level, type, "session.id",
         "tokens.input", "tokens.output", cost
  FROM fx_logs WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL
)"""


FX_SOURCE = """
fx_part AS (
  SELECT 'p' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
         'm' || CAST(conv_id AS VARCHAR) || '-' || CAST(CAST(floor(turn / 2) AS BIGINT) AS VARCHAR) AS message_id,
         's' || CAST(conv_id AS VARCHAR) AS session_id,
         CAST(1704067200000 + (conv_id * 1000 + turn) * 60000 AS BIGINT) AS time_created,
         CAST(1704067200000 + (conv_id * 1000 + turn) * 60000 + 1000 AS BIGINT) AS time_updated,
         conv_id, turn, role, text, (conv_id + turn) % 6 AS k
  FROM conversations
),
fx_message AS (
  SELECT message_id AS id, min(role) AS role FROM fx_part WHERE conv_id % 31 <> 0 GROUP BY 1
),
fx_session AS (
  SELECT 's' || CAST(conv_id AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS parent_id, 'slug' AS slug,
         '/work' AS directory, '/work' AS path, 'session ' || CAST(conv_id % 40 AS VARCHAR) AS title,
         '1.0.0' AS version, CAST(conv_id % 5 AS BIGINT) AS summary_additions,
         CAST(conv_id % 3 AS BIGINT) AS summary_deletions,
         CAST(1704067200000 + conv_id * 60000000 AS BIGINT) AS time_created,
         CAST(1704067200000 + conv_id * 60000000 + 1000 AS BIGINT) AS time_updated
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT 's-empty-' || CAST(i AS VARCHAR), NULL, 'slug', '/work', '/work', 'empty', '1.0.0',
         CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1704067200000 AS BIGINT), CAST(1704067201000 AS BIGINT)
  FROM range(3) t(i)
),
parts AS (
  SELECT p.id AS part_id, p.message_id, p.session_id, p.time_created, p.time_updated, m.role, s.title,
    CASE p.k WHEN 0 THEN 'text' WHEN 1 THEN 'reasoning' WHEN 2 THEN 'tool' WHEN 3 THEN 'step-finish'
             WHEN 4 THEN 'patch' ELSE 'step-start' END AS part_type,
    CASE WHEN p.k IN (0, 1) THEN p.text END AS text,
    CASE WHEN p.k = 1 THEN '{"end":' || CAST(p.turn + 1 AS VARCHAR) || ',"start":' || CAST(p.turn AS VARCHAR) || '}'
         END AS reasoning_time,
    CASE WHEN p.k = 2 THEN (['bash', 'edit', 'read'])[CAST(p.conv_id % 3 AS INTEGER) + 1] END AS tool,
    CASE WHEN p.k = 2 THEN 'completed' END AS tool_status,
    CASE WHEN p.k = 2 THEN '{"n":' || CAST(p.turn AS VARCHAR) || '}' END AS tool_input,
    CASE WHEN p.k = 2 THEN substring(p.text, 1, 100) END AS tool_output,
    CASE WHEN p.k = 3 THEN 'stop' END AS reason,
    CASE WHEN p.k = 3 THEN CAST(p.turn * 10 AS BIGINT) END AS tokens_input,
    CASE WHEN p.k = 3 THEN CAST(p.turn * 3 AS BIGINT) END AS tokens_output,
    CASE WHEN p.k = 3 THEN CAST(p.turn * 13 AS BIGINT) END AS tokens_total,
    CASE WHEN p.k = 3 THEN CAST(p.turn AS DOUBLE) / 100.0::DOUBLE END AS cost,
    CASE WHEN p.k = 4 THEN '["src/f' || CAST(p.conv_id % 7 AS VARCHAR) || '.py","src/g' || CAST(p.turn AS VARCHAR)
         || '.py"]' END AS files,
    p.conv_id, p.turn
  FROM fx_part p JOIN fx_message m ON m.id = p.message_id JOIN fx_session s ON s.id = p.session_id
),
files AS (
  SELECT session_id, title, part_id, make_timestamp(time_created * 1000) AS time_created,
         'src/f' || CAST(conv_id % 7 AS VARCHAR) || '.py' AS file
  FROM parts WHERE part_type = 'patch'
  UNION ALL
  SELECT session_id, title, part_id, make_timestamp(time_created * 1000) AS time_created,
         'src/g' || CAST(turn AS VARCHAR) || '.py' AS file
  FROM parts WHERE part_type = 'patch'
)"""

# The same source without the cuts: all messages, tool texts whole, three times.
FX_WHOLE = (
    FX_SOURCE.replace(" WHERE conv_id % 31 <> 0", "")
    .replace("substring(p.text, 1, 100)", "p.text || chr(10) || p.text || chr(10) || p.text")
)

PART_COLS = """part_id, message_id, session_id, time_created, time_updated, role, title, part_type, text,
  reasoning_time, tool, tool_status, tool_input, tool_output, reason, tokens_input, tokens_output, tokens_total,
  cost, files"""


def _part_cols(**replace: str) -> str:
    cols = [c.strip() for c in PART_COLS.replace("\n", " ").split(",")]
    return ", ".join(f"{replace[c]} AS {c}" if c in replace else c for c in cols)


def _load(n: int, turn_mod: int, bump: int = 0) -> str:
    cols = _part_cols(time_updated=f"time_updated + {bump}", text="text || ' (edited)'") if bump else PART_COLS
    return f"SELECT {n} AS load_id, {cols} FROM parts WHERE turn % 3 = {turn_mod}"


LOADS = f"""
loads AS (
  {_load(0, 0)}
  UNION ALL {_load(1, 1)}
  UNION ALL {_load(1, 0, 1000)}
  UNION ALL {_load(2, 2)}
  UNION ALL {_load(2, 1, 2000)}
)"""


def _newest(where: str = "") -> str:
    return f"""SELECT {PART_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY time_updated DESC, load_id DESC) AS rn
  FROM loads {where}) WHERE rn = 1"""


LOG_LINES_EXPECTED = """SELECT ts AS "timestamp", event_type AS level, 's' || CAST(user_id AS VARCHAR) AS session_id,
       CAST(value AS VARCHAR) AS cost, 'user ' || CAST(user_id AS VARCHAR) || ' did ' || event_type AS message,
       '' AS empty, '2' AS dup
FROM events"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


def _describe_numeric(col: str) -> str:
    return f"""SELECT '{col}' AS "column", count({col}) AS count,
  round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std,
  round(CAST(min({col}) AS DOUBLE), 6) AS min,
  round(quantile_cont({col}, 0.25), 6) AS p25, round(quantile_cont({col}, 0.5), 6) AS p50,
  round(quantile_cont({col}, 0.75), 6) AS p75, round(CAST(max({col}) AS DOUBLE), 6) AS max
FROM events"""


def _describe_text(col: str) -> str:
    return f"""SELECT '{col}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(v) AS unique,
  arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM events WHERE {col} IS NOT NULL GROUP BY 1)"""


_TIMELINE = """SELECT session_id, part_id, seq, time_created,
  CASE WHEN part_type = 'text' AND role = 'user' THEN 'user' WHEN part_type = 'text' THEN 'assistant'
       ELSE part_type END AS kind,
  CASE part_type WHEN 'text' THEN coalesce(text, '')
    WHEN 'reasoning' THEN left(coalesce(text, ''), 2000)
    WHEN 'tool' THEN coalesce(nullif(tool, ''), '?') || ' · ' || coalesce(tool_status, '')
    WHEN 'step-finish' THEN coalesce(CAST(tokens_total AS VARCHAR), '-') || ' tokens · ' || coalesce(CAST(cost AS VARCHAR), '-')
    WHEN 'patch' THEN 'src/f' || CAST(conv_id % 7 AS VARCHAR) || '.py, src/g' || CAST(turn AS VARCHAR) || '.py'
    ELSE '' END AS body,
  CASE WHEN part_type = 'tool' THEN tool_input END AS tool_input,
  CASE WHEN part_type = 'tool' THEN left(coalesce(tool_output, ''), 4000) END AS tool_output
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY time_created, part_id) AS seq FROM parts)
WHERE seq <= 200"""


_DESCRIBE_TIME = """SELECT 'ts' AS "column", count(ts) AS count,
  make_timestamp(CAST(round(avg(epoch_us(ts))) AS BIGINT)) AS mean,
  min(ts) AS min,
  make_timestamp(CAST(round(quantile_cont(epoch_us(ts), 0.25)) AS BIGINT)) AS p25,
  make_timestamp(CAST(round(quantile_cont(epoch_us(ts), 0.5)) AS BIGINT)) AS p50,
  make_timestamp(CAST(round(quantile_cont(epoch_us(ts), 0.75)) AS BIGINT)) AS p75,
  max(ts) AS max
FROM events"""


ORACLE: dict[str, str] = {
    # ------------------------------------------------------ conversations
    "q_parts_join": _with(FX_SOURCE) + "SELECT part_id, message_id, session_id, title FROM parts",
    "q_parts_extract": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts",
    "q_sessions_projection": _with(FX_SOURCE) + "SELECT * FROM fx_session",
    "q_session_summary": _with(FX_SOURCE)
    + """, agg AS (
  SELECT session_id, count(part_id) AS nb_parts, count(tool) AS nb_tools, count(DISTINCT message_id) AS nb_messages,
         CAST(coalesce(sum(CAST(cost AS DECIMAL(38, 10))), 0) AS DOUBLE) AS cost,
         CAST(coalesce(sum(tokens_total), 0) AS BIGINT) AS tokens
  FROM parts WHERE session_id IS NOT NULL GROUP BY 1)
SELECT s.id, s.title, make_timestamp(s.time_created * 1000) AS dt, s.summary_additions, s.summary_deletions,
       a.nb_parts, a.nb_tools, a.nb_messages, a.cost, a.tokens
FROM fx_session s LEFT JOIN agg a ON s.id = a.session_id""",
    "q_whole_parts": _with(FX_WHOLE) + f"SELECT {PART_COLS} FROM parts",
    "q_whole_timeline": _with(FX_WHOLE) + _TIMELINE,
    "q_tool_calls_ranked": _with(FX_WHOLE)
    + """SELECT part_id, session_id, time_created, coalesce(nullif(tool, ''), '?') AS tool, left(coalesce(title, ''), 50) AS title,
       coalesce(tool_status, '') AS tool_status, tool_input, left(coalesce(tool_output, ''), 4000) AS tool_output,
       row_number() OVER (ORDER BY time_created, part_id) AS pos
FROM parts WHERE part_type = 'tool'""",
    "q_session_summary_ranked": _with(FX_WHOLE)
    + """, agg AS (
  SELECT session_id, count(part_id) AS nb_parts, count(DISTINCT message_id) AS nb_messages,
         CAST(coalesce(sum(CAST(cost AS DECIMAL(38, 10))), 0) AS DOUBLE) AS cost
  FROM parts WHERE session_id IS NOT NULL GROUP BY 1)
SELECT s.id, make_timestamp(s.time_created * 1000) AS dt, a.nb_parts, a.nb_messages, a.cost,
       row_number() OVER (ORDER BY s.time_created DESC NULLS LAST, s.id) AS pos
FROM fx_session s LEFT JOIN agg a ON s.id = a.session_id""",
    "q_export_filtered": _with(FX_WHOLE) + f"SELECT {PART_COLS} FROM parts WHERE session_id = 's7'",
    "q_session_list": _with(FX_SOURCE)
    + """SELECT id, left(title, 60) || ' (' || id || ')' AS label, make_timestamp(time_created * 1000) AS dt,
       row_number() OVER (ORDER BY time_created DESC, id) AS pos
FROM fx_session""",
    "q_timeline": _with(FX_SOURCE) + _TIMELINE,
    "q_timeline_first": _with(FX_SOURCE)
    + """SELECT session_id, part_id, seq
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY time_created, part_id) AS seq FROM parts)
WHERE seq <= 3""",
    "q_tool_names": _with(FX_SOURCE)
    + "SELECT DISTINCT tool FROM parts WHERE part_type = 'tool' AND tool IS NOT NULL",
    "q_tool_calls": _with(FX_SOURCE)
    + """SELECT part_id, session_id, time_created, coalesce(nullif(tool, ''), '?') AS tool, left(coalesce(title, ''), 50) AS title,
       coalesce(tool_status, '') AS tool_status, tool_input, left(coalesce(tool_output, ''), 4000) AS tool_output
FROM parts
WHERE part_type = 'tool' AND tool IN ('bash', 'edit')
  AND session_id IN (SELECT session_id FROM parts WHERE part_type = 'patch')""",
    "q_files_touched": _with(FX_SOURCE) + "SELECT session_id, title, part_id, time_created, file FROM files",
    "q_files_total": _with(FX_SOURCE) + "SELECT count(*) AS files, count(DISTINCT file) AS distinct_files FROM files",
    "q_files_per_title": _with(FX_SOURCE)
    + "SELECT title, count(*) AS count FROM files WHERE title IS NOT NULL GROUP BY 1",
    "q_files_per_session": _with(FX_SOURCE)
    + "SELECT session_id, count(*) AS count FROM files WHERE session_id IS NOT NULL GROUP BY 1",
    "q_tool_call_count": _with(FX_SOURCE)
    + "SELECT count(*) AS calls FROM parts WHERE part_type = 'tool' AND tool IN ('bash', 'read')",
    "q_hot_files": _with(FX_SOURCE)
    + "SELECT file, count(*) AS touches, count(DISTINCT session_id) AS sessions FROM files GROUP BY 1",
    "q_part_type_counts": _with(FX_SOURCE)
    + "SELECT session_id, part_type, count(*) AS n FROM parts GROUP BY 1, 2 ORDER BY n DESC, session_id, part_type LIMIT 50",
    "q_part_types": _with(FX_SOURCE) + "SELECT part_type, count(*) AS n FROM parts GROUP BY 1",
    "q_cost_per_message": _with(FX_SOURCE)
    + """SELECT session_id, message_id, count(part_id) AS nb_parts,
       CAST(coalesce(sum(CAST(cost AS DECIMAL(38, 10))), 0) AS DOUBLE) AS cost,
       CAST(coalesce(sum(tokens_total), 0) AS BIGINT) AS tokens
FROM parts GROUP BY 1, 2""",
    "q_logs_x_sessions": _with(FX_LOGS, FX_SOURCE)
    + """, lc AS (SELECT "session.id" AS session_id, count(*) AS log_events FROM fx_logs
            WHERE "session.id" IS NOT NULL GROUP BY 1),
pc AS (SELECT session_id, count(part_id) AS nb_parts FROM parts GROUP BY 1),
j AS (SELECT coalesce(s.id, lc.session_id) AS session_id, s.title, lc.log_events
      FROM fx_session s FULL OUTER JOIN lc ON s.id = lc.session_id)
SELECT coalesce(j.session_id, pc.session_id) AS session_id, j.title, j.log_events, pc.nb_parts
FROM j FULL OUTER JOIN pc ON j.session_id = pc.session_id""",
    "q_logs_in_progress": _with(FX_SOURCE)
    + """, e AS (
  SELECT event_id, event_type AS level,
         CASE WHEN event_id % 97 <> 0 THEN 's' || CAST(conv AS VARCHAR) END AS session_id,
         CASE WHEN event_id % 101 <> 0 THEN make_timestamp(CAST(1704067200000
              + (conv * 1000 + event_id % 13 - 2) * 60000 + event_id % 5 * 1000 AS BIGINT) * 1000) END AS "timestamp"
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 131 END AS conv FROM events)),
p AS (SELECT session_id, make_timestamp(time_created * 1000) AS part_created, part_id, message_id, part_type FROM parts)
SELECT e.event_id, e."timestamp", e.level, e.session_id, p.part_id, p.message_id, p.part_type, p.part_created
FROM e ASOF LEFT JOIN p ON e.session_id = p.session_id AND e."timestamp" >= p.part_created""",
    # -------------------------------------------------- sources and sinks
    "q_inventory": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"table\", 'logs' AS kind, count(*) > 0 AS has_bytes, count(*) AS rows FROM {n}"
        for n in ("events", "documents", "conversations", "lineitem", "orders", "customer")
    ),
    "q_inventory_rows": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}"
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                  "embeddings", "pages", "benchmark", "labels", "conversations")
    ),
    "q_log_parse": LOG_LINES_EXPECTED,
    "q_log_parse_session": """SELECT ts AS "timestamp", event_type AS level, 's7' AS session_id, CAST(value AS VARCHAR) AS cost
FROM events WHERE user_id = 7""",
    "q_log_schema": _with(FX_LOGS)
    + "\nUNION ALL\n".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", 'string' AS type, count("{c}") AS filled FROM fx_logs"""
        for i, c in enumerate(("timestamp", "level", "type", "session.id", "tokens.input", "tokens.output", "cost"))
    ),
    "q_union_by_name": """SELECT ts AS "timestamp", event_type AS level, 's' || CAST(user_id AS VARCHAR) AS session_id,
       CAST(NULL AS VARCHAR) AS cost, 'a' AS file FROM events WHERE event_id % 2 = 0
UNION ALL
SELECT ts, NULL, 's' || CAST(user_id AS VARCHAR), CAST(value AS VARCHAR), 'b' FROM events WHERE event_id % 2 = 1""",
    "q_mixed_types": """SELECT 'p' || event_id AS part_id, 's' || user_id AS session_id,
       CASE WHEN event_id % 3 = 2 THEN 'text' END AS part_type,
       CASE WHEN event_id % 3 > 0 AND event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 50 AS BIGINT) END AS tokens_total,
       CASE WHEN event_id % 3 = 1 THEN CAST(value AS DOUBLE) END AS cost FROM events""",
    "q_roundtrip": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts",
    "q_source_roundtrip": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts",
    "q_session_export": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts",
    "q_session_export_one": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts WHERE session_id = 's1'",
    "q_session_buckets": _with(FX_WHOLE) + f"SELECT {PART_COLS} FROM parts",
    "q_session_from_bucket": _with(FX_WHOLE) + f"SELECT {PART_COLS} FROM parts WHERE session_id = 's1'",
    "q_ctas_idempotent": _with(FX_SOURCE) + f"SELECT {PART_COLS} FROM parts",
    # ---------------------------------------------------------------- SQL
    "q_sql_explorer": _with(FX_SOURCE) + "SELECT part_type, count(*) AS n FROM parts GROUP BY part_type",
    "q_sql_result_cap": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber LIMIT 2000""",
    "q_sql_total": """SELECT row_number() OVER (ORDER BY n DESC, l_orderkey) AS pos, l_orderkey, n, count(*) OVER () AS total
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ORDER BY n DESC, l_orderkey LIMIT 100""",
    "q_sql_functions": _with(FX_LOGS)
    + """SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS count, sum(TRY_CAST("tokens.input" AS DOUBLE)) AS tokens
FROM valid GROUP BY 1""",
    "q_sql_timelines": _with(FX_WHOLE) + _TIMELINE,
    "q_sql_summaries": _with(FX_WHOLE)
    + """, agg AS (
  SELECT session_id, count(part_id) AS nb_parts, count(tool) AS nb_tools, count(DISTINCT message_id) AS nb_messages,
         CAST(coalesce(sum(CAST(cost AS DECIMAL(38, 10))), 0) AS DOUBLE) AS cost,
         CAST(coalesce(sum(tokens_total), 0) AS BIGINT) AS tokens
  FROM parts WHERE session_id IS NOT NULL GROUP BY 1)
SELECT left(s.title, 60) || ' (' || s.id || ')' AS label, s.id, s.title, make_timestamp(s.time_created * 1000) AS dt,
       s.summary_additions, s.summary_deletions, a.nb_parts, a.nb_tools, a.nb_messages, a.cost, a.tokens
FROM fx_session s LEFT JOIN agg a ON s.id = a.session_id""",
    "q_json_safe": """SELECT event_id,
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
  CAST(CAST(value AS DECIMAL(10, 2)) AS DOUBLE) AS amount,
  to_base64(encode(event_type)) AS raw,
  '[' || CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) || ']' AS ids,
  '{"' || CAST(user_id AS VARCHAR) || '":"' || event_type || '"}' AS by_user
FROM events""",
    # -------------------------------------------------- versioned tables
    "q_dedup_latest": _with(FX_SOURCE, LOADS) + _newest(),
    "q_upsert": _with(FX_SOURCE, LOADS) + _newest(),
    "q_insert_only": _with(FX_SOURCE, LOADS)
    + f"""SELECT CAST(load_id AS BIGINT) AS load_id, {PART_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY load_id) AS rn FROM loads
  WHERE CAST(regexp_extract(part_id, '-(\\d+)$', 1) AS BIGINT) % 4 <> 3) WHERE rn = 1
UNION ALL
SELECT min(load_id), {_part_cols(part_id="NULL")} FROM loads
WHERE CAST(regexp_extract(part_id, '-(\\d+)$', 1) AS BIGINT) % 4 = 3 GROUP BY {PART_COLS}""",
    "q_as_of": _with(FX_SOURCE, LOADS) + _newest("WHERE load_id <= 1"),
    "q_load_history": _with(FX_SOURCE, LOADS)
    + """, firsts AS (SELECT load_id, count(*) AS inserts
                FROM (SELECT part_id, min(load_id) AS load_id FROM loads GROUP BY 1) GROUP BY 1),
per_load AS (SELECT load_id, count(*) AS rows FROM loads GROUP BY 1)
SELECT p.load_id, CASE WHEN p.rows - coalesce(f.inserts, 0) = 0 THEN 'append' ELSE 'upsert' END AS operation,
       p.rows, coalesce(f.inserts, 0) AS inserts, p.rows - coalesce(f.inserts, 0) AS updates
FROM per_load p LEFT JOIN firsts f ON p.load_id = f.load_id""",
    "q_sketch_distinct": _with(FX_SOURCE, LOADS)
    + "\nUNION ALL\n".join(
        f"""SELECT CAST({a} AS BIGINT) AS first, CAST({b} AS BIGINT) AS last, '{c}' AS "column", count(DISTINCT {c}) AS exact, TRUE AS within
FROM loads WHERE load_id BETWEEN {a} AND {b}"""
        for a, b in ((0, 0), (0, 1), (1, 2), (0, 2)) for c in ("session_id", "message_id", "part_id")
    ),
    "q_sketch_quartiles": _with(FX_SOURCE, LOADS)
    + "\nUNION ALL\n".join(
        f"""SELECT CAST({a} AS BIGINT) AS first, CAST({b} AS BIGINT) AS last, '{c}' AS "column", CAST({q} AS DOUBLE) AS fraction,
  count({c}) AS n, TRUE AS within FROM loads WHERE load_id BETWEEN {a} AND {b}"""
        for a, b in ((0, 0), (0, 1), (1, 2), (0, 2)) for c in ("tokens_total", "time_created") for q in (0.25, 0.5, 0.75)
    ),
    "q_partition_prune": _with(FX_SOURCE)
    + """SELECT strftime(make_timestamp(time_created * 1000), '%Y-%m') AS month, count(*) AS parts,
       count(DISTINCT session_id) AS sessions
FROM parts GROUP BY 1""",
    "q_partition_month": _with(FX_SOURCE)
    + """SELECT part_id, session_id, '2024-02' AS month FROM parts
WHERE strftime(make_timestamp(time_created * 1000), '%Y-%m') = '2024-02'""",
    "q_schema_evolution": _with(FX_SOURCE)
    + f"SELECT {_part_cols(files='CASE WHEN turn % 2 = 0 THEN NULL ELSE files END')} FROM parts",
    # --------------------------------------------------------- streaming
    "q_stream_ingest": LOG_LINES_EXPECTED,
    "q_stream_hourly": """SELECT date_trunc('hour', ts) AS hour, count(*) AS count FROM events GROUP BY 1
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "q_stream_late": """SELECT date_trunc('hour', ts) AS hour, count(*) AS count,
  (SELECT max(date_trunc('hour', ts)) FROM events) >= date_trunc('hour', ts) + INTERVAL 70 MINUTE AS settled
FROM events GROUP BY 1""",
    "q_stream_dedup": _with(FX_SOURCE, LOADS) + "SELECT DISTINCT part_id, session_id, part_type FROM loads",
    "q_stream_upsert": _with(FX_SOURCE, LOADS) + _newest(),
    # ----------------------------------------------------------- overview
    "q_hourly": _with(FX_LOGS)
    + """SELECT date_trunc('hour', "timestamp") AS hour, count(*) AS count FROM valid GROUP BY 1""",
    "q_levels": _with(FX_LOGS)
    + """SELECT coalesce(level, 'unknown') AS level, count(*) AS count FROM valid GROUP BY 1""",
    "q_lenient_numeric": _with(FX_LOGS)
    + """SELECT cost AS cost_text, TRY_CAST(cost AS DOUBLE) AS cost_value FROM fx_logs""",
    "q_dst_times": """SELECT event_id, dt, dt AS text_dt, date_trunc('hour', dt) AS hour
FROM (SELECT event_id, make_timestamp(CAST(CASE WHEN event_id % 2 = 0 THEN 1710054000000 ELSE 1730613600000 END
             + (event_id * 61 % 720 - 360) * 60000 AS BIGINT) * 1000) AS dt FROM events)""",
    "q_tokens_long": _with(FX_LOGS)
    + """SELECT "session.id" AS session_id, 'tokens.input' AS type,
       sum(coalesce(TRY_CAST("tokens.input" AS DOUBLE), 0)) AS tokens
FROM valid WHERE "session.id" IS NOT NULL GROUP BY 1
UNION ALL
SELECT "session.id" AS session_id, 'tokens.output' AS type,
       sum(coalesce(TRY_CAST("tokens.output" AS DOUBLE), 0)) AS tokens
FROM valid WHERE "session.id" IS NOT NULL GROUP BY 1""",
    "q_top_sessions": _with(FX_LOGS)
    + """SELECT coalesce("session.id", 'unknown') AS session, count(*) AS count
FROM valid GROUP BY 1 ORDER BY count DESC, session LIMIT 10""",
    "q_cumulative_cost": _with(FX_LOGS)
    + """SELECT "timestamp", CAST(c AS DOUBLE) AS cost,
       CAST(sum(c) OVER (ORDER BY "timestamp", c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         AS cumulative
FROM (SELECT "timestamp", TRY_CAST(TRY_CAST(cost AS DOUBLE) AS DECIMAL(38, 10)) AS c FROM valid)
WHERE c IS NOT NULL""",
    "q_cumulative_ties": """SELECT ts AS "timestamp", CAST(c AS DOUBLE) AS cost,
  CAST(sum(c) OVER (ORDER BY ts, c ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative
FROM (SELECT CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15 12:00:00' ELSE ts END AS ts,
             CAST(CASE WHEN event_id % 3 = 0 THEN 0.25 ELSE value END AS DECIMAL(38, 10)) AS c FROM events)
WHERE c IS NOT NULL AND ts IS NOT NULL""",
    "q_load_metrics": _with(FX_LOGS)
    + """SELECT count(*) AS rows, CAST(8 AS BIGINT) AS columns, CAST(1 AS BIGINT) AS files FROM fx_logs""",
    "q_describe": "\nUNION ALL\n".join(_describe_numeric(c) for c in ("event_id", "user_id", "value")),
    "q_describe_time": _DESCRIBE_TIME,
    "q_describe_mixed": "\nUNION ALL\n".join(
        f"""SELECT "column", 'number' AS kind, count, mean, std, min, p25, p50, p75, max, NULL::TIMESTAMP AS mean_at,
  NULL::TIMESTAMP AS min_at, NULL::TIMESTAMP AS p25_at, NULL::TIMESTAMP AS p50_at, NULL::TIMESTAMP AS p75_at,
  NULL::TIMESTAMP AS max_at FROM ({_describe_numeric(c)})"""
        for c in ("event_id", "user_id", "value")
    )
    + f"""
UNION ALL
SELECT "column", 'time', count, NULL, NULL, NULL, NULL, NULL, NULL, NULL, mean, min, p25, p50, p75, max
FROM ({_DESCRIBE_TIME})""",
    "q_describe_text": "\nUNION ALL\n".join(_describe_text(c) for c in ("event_type", "props")),
}
