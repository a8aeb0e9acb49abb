"""The library's expressions and operators for free SQL (Q1), as SQL functions.

Each is declared in SQL (``CREATE TEMPORARY FUNCTION ... RETURN``), so Spark puts its
text into the query and optimises it there: filters on a table function reach the
scans, and no row passes through Python.  The tests hold every function against
the DataFrame form.  Table functions read the views of ``sqlapi.register_views``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tracelake.operators.timeline import OUTPUT_CHARS, REASONING_CHARS
from tracelake.schemas import PARTS, SESSIONS

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# name, parameters, result, body
SCALARS = [
    # text to a UTC wall clock; NULL where it is no time
    (
        "lenient_time", "s STRING", "TIMESTAMP_NTZ",
        rf"""CASE WHEN trim(s) RLIKE r'([zZ]|[+-]\d{{2}}(:?\d{{2}})?)$' AND contains(s, ':')
             THEN timestampadd(MICROSECOND, unix_micros(try_to_timestamp(trim(s))), {_EPOCH})
             ELSE try_cast(trim(s) AS TIMESTAMP_NTZ) END""",
    ),
    # epoch milliseconds
    ("epoch_time", "ms BIGINT", "TIMESTAMP_NTZ", f"timestampadd(MILLISECOND, ms, {_EPOCH})"),
    # F5
    ("hour_of", "t TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "timestampadd(HOUR, hour(t), CAST(CAST(t AS DATE) AS TIMESTAMP_NTZ))"),
    # text to number; NULL where it is none, or NaN
    (
        "lenient_number", "s STRING", "DOUBLE",
        r"""CASE WHEN lower(s) RLIKE r'^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity)\s*$'
             AND NOT isnan(try_cast(s AS DOUBLE)) THEN try_cast(s AS DOUBLE) END""",
    ),
    # only a JSON array is a list
    ("file_list", "s STRING", "ARRAY<STRING>", "CASE WHEN startswith(trim(s), '[') THEN from_json(trim(s), 'array<string>') END"),
    # F15
    ("session_label", "title STRING, id STRING", "STRING", "concat(left(coalesce(title, ''), 60), ' (', id, ')')"),
    # a double as Python prints it (scalars.number_text)
    (
        "number_text", "v DOUBLE", "STRING",
        r"""CASE WHEN NOT contains(CAST(v AS STRING), 'E') THEN CAST(v AS STRING)
             WHEN try_cast(split_part(CAST(v AS STRING), 'E', 2) AS INT) BETWEEN -4 AND 15
             THEN regexp_replace(regexp_replace(CAST(try_cast(CAST(v AS STRING) AS DECIMAL(38, 20)) AS STRING), '0+$', ''), r'\.$', '.0')
             ELSE concat(regexp_replace(split_part(CAST(v AS STRING), 'E', 1), r'\.0$', ''),
                         CASE WHEN try_cast(split_part(CAST(v AS STRING), 'E', 2) AS INT) < 0 THEN 'e-' ELSE 'e+' END,
                         lpad(CAST(abs(try_cast(split_part(CAST(v AS STRING), 'E', 2) AS INT)) AS STRING),
                              greatest(2, length(CAST(abs(try_cast(split_part(CAST(v AS STRING), 'E', 2) AS INT)) AS STRING))), '0'))
             END""",
    ),
]

TABLES = [
    # The first parts of every session as display rows
    (
        "timelines", "n INT",
        "session_id STRING, part_id STRING, seq BIGINT, time_created BIGINT, kind STRING, body STRING, tool_input STRING, tool_output STRING",
        f"""SELECT * FROM (
  SELECT session_id, part_id, seq, time_created,
    CASE WHEN part_type = 'text' AND role = 'user' THEN 'user' WHEN part_type = 'text' THEN 'assistant'
         WHEN part_type IN ('reasoning', 'tool', 'step-finish', 'patch', 'step-start') THEN part_type END AS kind,
    CASE part_type WHEN 'text' THEN coalesce(text, '')
      WHEN 'reasoning' THEN left(coalesce(text, ''), {REASONING_CHARS})
      WHEN 'tool' THEN concat(coalesce(nullif(tool, ''), '?'), ' · ', coalesce(tool_status, ''))
      WHEN 'step-finish' THEN concat(coalesce(CAST(tokens_total AS STRING), '-'), ' tokens · ', coalesce(number_text(cost), '-'))
      WHEN 'patch' THEN coalesce(array_join(file_list(files), ', '), '')
      WHEN 'step-start' THEN '' END AS body,
    CASE WHEN part_type = 'tool' THEN tool_input END AS tool_input,
    CASE WHEN part_type = 'tool' THEN left(coalesce(tool_output, ''), {OUTPUT_CHARS}) END AS tool_output
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY time_created, part_id) AS seq FROM parts)
  WHERE seq <= n) WHERE kind IS NOT NULL""",
    ),
    # Every session with its metrics
    (
        "session_summaries", "",
        "id STRING, title STRING, dt TIMESTAMP_NTZ, summary_additions BIGINT, summary_deletions BIGINT, nb_parts BIGINT, "
        "nb_tools BIGINT, nb_messages BIGINT, cost DOUBLE, tokens BIGINT",
        """SELECT s.id, s.title, epoch_time(s.time_created), s.summary_additions, s.summary_deletions,
       m.nb_parts, m.nb_tools, m.nb_messages, m.cost, m.tokens
FROM sessions s LEFT JOIN (
  SELECT session_id, count(part_id) AS nb_parts, count(tool) AS nb_tools, count(DISTINCT message_id) AS nb_messages,
         CAST(coalesce(sum(try_cast(cost AS DECIMAL(38, 10))), 0) AS DOUBLE) AS cost,
         CAST(coalesce(sum(tokens_total), 0) AS BIGINT) AS tokens
  FROM parts WHERE session_id IS NOT NULL GROUP BY session_id) m ON s.id = m.session_id""",
    ),
]


def _has(spark: SparkSession, view: str, columns: list[str]) -> bool:
    return spark.catalog.tableExists(view) and set(columns) <= set(spark.table(view).columns)


def register_functions(spark: SparkSession) -> list[str]:
    """Declare the scalar functions, and the table functions as far as views
    ``parts`` and ``sessions`` with the columns they read are registered; returns
    the names."""
    names = []
    for name, parameters, result, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
        names.append(name)
    parts, sessions = ("parts", PARTS), ("sessions", SESSIONS)
    needs = {"timelines": [parts], "session_summaries": [parts, sessions]}
    for name, parameters, result, body in TABLES:
        if all(_has(spark, view, schema.fieldNames()) for view, schema in needs[name]):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({result}) RETURN {body}")
            names.append(name)
    return names
