"""``key=value`` log lines -> typed ``logs`` rows.

A pair is a key (a word character, then word characters or dots), ``=``,
then either a double-quoted value (no escape handling: it ends at the next
quote) or the run of non-blank characters.  ``k=`` and ``k=""`` both give
``''``; a key seen twice keeps its last value.  Character classes are
Unicode-aware, as in Python.

Everything is column expressions: ``regexp_extract_all`` for the three
groups, array functions for last-wins, a map for the keys we do not type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.scalars import to_ts, to_ts_strict
from tracelake.schemas import LOG_FIELDS

# Fixed value: the pair pattern (Unicode classes via the (?U) flag).
PAIR_RE = r'(?U)(\w[\w.]*)=(?:"([^"]*)"|(\S*))'
BLANK_LINE_RE = r"(?U)^\s*$"


def _unquote(v: Column) -> Column:
    """The value part of one match.  The quoted branch is tried first, so a
    value that starts and ends with a quote (two characters at least) came
    from it: drop the quotes.  Anything else is the bare run as is."""
    quoted = v.startswith('"') & v.endswith('"') & (F.length(v) >= 2)
    return F.when(quoted, v.substr(F.lit(2), F.length(v) - 2)).otherwise(v)


def parse_pairs(line: Column) -> tuple[Column, Column]:
    """Keys and values of all pairs of a line, in order (duplicates kept).

    One regex pass returns the whole matches; key and value are split at the
    first ``=`` (a key cannot contain one)."""
    matches = F.regexp_extract_all(line, F.lit(PAIR_RE), 0)
    keys = F.transform(matches, lambda m: F.substring_index(m, "=", 1))
    values = F.transform(matches, lambda m: _unquote(m.substr(F.locate("=", m) + 1, F.length(m))))
    return keys, values


def last_value(keys: Column, values: Column, key: str) -> Column:
    """The last value of ``key``, NULL when absent."""
    pos = F.array_position(F.reverse(keys), F.lit(key))
    return F.when(pos > 0, F.element_at(F.reverse(values), pos.cast("int")))


def parse_log_lines(
    lines: DataFrame, session_id: str | None = None, strict: bool = True, line_col: str = "value"
) -> DataFrame:
    """One ``logs`` row per line.

    Known fields become columns (``timestamp`` parsed: strict fails the job
    on a bad value, lenient gives NULL); other keys go to ``extras`` with
    last-wins.  ``session_id`` keeps one session's lines only.
    """
    if session_id is not None:
        # A line of that session contains the id: cheap pre-filter before the regex.
        lines = lines.where(F.col(line_col).contains(session_id))
    keys, values = parse_pairs(F.col(line_col))
    staged = lines.select(
        *[c for c in lines.columns if c == "filename"],
        keys.alias("_tl_k"),
        values.alias("_tl_v"),
    )
    k, v = F.col("_tl_k"), F.col("_tl_v")
    fields = {name: last_value(k, v, name) for name in LOG_FIELDS}
    n = F.size(k)
    known = F.array(*[F.lit(x) for x in LOG_FIELDS])
    entries = F.filter(
        F.arrays_zip(k.alias("key"), v.alias("value")),
        lambda e, i: (F.array_position(F.reverse(k), e["key"]) == n - i) & ~F.array_contains(known, e["key"]),
    )
    parse_ts = to_ts_strict if strict else to_ts
    out = staged.select(
        parse_ts(fields["timestamp"]).alias("timestamp"),
        *[fields[name].alias(name) for name in LOG_FIELDS[1:]],
        (F.col("filename") if "filename" in staged.columns else F.lit(None).cast("string")).alias("filename"),
        F.map_from_entries(entries).alias("extras"),
    )
    if session_id is not None:
        out = out.where(F.col("`session.id`") == F.lit(session_id))
    return out


def drop_blank(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return lines.where(~F.col(line_col).rlike(BLANK_LINE_RE))
