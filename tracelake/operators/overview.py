"""Overview of a ``logs`` table: activity, levels, tokens, sessions, cost.

Every result is computed on ``valid_logs`` (rows whose timestamp parses), as
in the dashboard being replaced.  Callers asking for several results may
``persist()`` the valid set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.scalars import (
    epoch, fill_label, from_micros, hour_floor, lenient_double, typed_decimal, utc_wall_clock,
)
from tracelake.plans.ordering import running_total
from tracelake.plans.selection import interpolated, order_statistics

SESSION = "`session.id`"


def valid_logs(logs: DataFrame, ts: str = "timestamp") -> DataFrame:
    """The timestamp as a UTC ``timestamp_ntz`` (text parsed
    leniently, typed values converted) and only the rows where it is set."""
    parsed = logs.withColumn(ts, utc_wall_clock(F.col(f"`{ts}`"), logs.schema[ts].dataType))
    return parsed.where(F.col(f"`{ts}`").isNotNull())


def hourly_activity(valid: DataFrame, ts: str = "timestamp") -> DataFrame:
    """A1: events per hour; hours without events are absent."""
    return (
        valid.groupBy(hour_floor(F.col(f"`{ts}`")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("hour")
    )


def level_counts(valid: DataFrame, unknown: str = "unknown") -> DataFrame:
    """A2: events per level, NULL level counted under ``unknown``."""
    return (
        valid.groupBy(fill_label(F.col("level"), unknown).alias("level"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "level")
    )


def tokens_per_session(valid: DataFrame) -> DataFrame:
    """A3: input and output token sums per session (bad text counts 0)."""
    return (
        valid.where(F.col(SESSION).isNotNull())
        .groupBy(F.col(SESSION).alias("session_id"))
        .agg(
            F.sum(F.coalesce(lenient_double(F.col("`tokens.input`")), F.lit(0.0))).alias("tokens.input"),
            F.sum(F.coalesce(lenient_double(F.col("`tokens.output`")), F.lit(0.0))).alias("tokens.output"),
        )
    )


def tokens_long(per_session: DataFrame) -> DataFrame:
    """Melt the two token columns into (session_id, type, tokens)."""
    return per_session.unpivot(
        ["session_id"], ["`tokens.input`", "`tokens.output`"], "type", "tokens"
    ).fillna(0.0, subset=["tokens"])


def top_sessions(valid: DataFrame, k: int = 10, unknown: str = "unknown") -> DataFrame:
    """A4: the ``k`` sessions with most events (ties: session ascending)."""
    return (
        valid.groupBy(fill_label(F.col(SESSION), unknown).alias("session"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "session")
        .limit(k)
    )


def cumulative_cost(
    df: DataFrame, ts: str = "timestamp", cost: str = "cost", out: str = "cumulative"
) -> DataFrame:
    """Running sum of cost over time.

    Costs are parsed leniently and summed as exact decimals; rows without a
    time or cost are dropped.  The running sum is computed bucket by bucket
    (see ``plans.ordering``), never in one task; rows equal in both are one
    weighted row on the way.
    """
    base = df.select(
        F.col(f"`{ts}`").alias("timestamp"),
        typed_decimal(F.col(f"`{cost}`"), df.schema[cost].dataType).alias("cost"),
    ).na.drop(subset=["timestamp", "cost"])
    return running_total(base, ["timestamp", "cost"], "cost", out)


def load_metrics(logs: DataFrame, filename: str = "filename") -> DataFrame:
    """One row with the row, column and file counts of a loaded table."""
    return logs.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(logs.columns)).cast("bigint").alias("columns"),
        F.count_distinct(F.col(f"`{filename}`")).alias("files"),
    )


def schema_of(df: DataFrame) -> DataFrame:
    """Column list and types, one row per column, in order."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string")


# ------------------------------------------------------------- describe

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIME = (T.TimestampType, T.TimestampNTZType, T.DateType)
QUANTILES = (0.25, 0.5, 0.75)


STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _described(df: DataFrame, values: dict) -> dict[str, tuple]:
    """``count`` and ``STATS`` of each column of numbers: exact, all columns in the
    same few passes (``plans.selection``), nothing sorted."""
    kinds = [f.dataType for f in df.select(*values.values()).schema.fields]
    aggs = []
    for i, (v, t) in enumerate(zip(values.values(), kinds, strict=True)):
        integral = isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        # Integral values are averaged exactly (a double sum drifts on large values).
        mean = F.sum(v.cast("decimal(38,0)")).cast("double") / F.count(v) if integral else F.avg(v).cast("double")
        mean = F.when(F.count(v) > 0, mean)
        aggs += [a.cast("double").alias(f"{n}{i}") for n, a in zip("asnx", (mean, F.stddev_samp(v), F.min(v), F.max(v)), strict=True)]
    counts, found, extra = order_statistics(df, values, QUANTILES, also=aggs)
    out = {}
    for i, c in enumerate(values):
        mean, std, low, high = extra[4 * i : 4 * i + 4]
        quartiles = [interpolated(*found[c, q]) if counts[c] else None for q in QUANTILES]
        out[c] = counts[c], mean, std, low, *quartiles, high
    return out


def _present(df: DataFrame, c: str):
    """NaN counts as missing, as in pandas."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def _micros(df: DataFrame, c: str):
    return F.timestamp_diff("MICROSECOND", epoch(), utc_wall_clock(F.col(f"`{c}`"), df.schema[c].dataType))


def describe_approx(df: DataFrame, numeric: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """A9 in one pass for very large inputs: quartiles from a bounded-memory
    quantile sketch (``percentile_approx``), no sort; other statistics exact."""
    rows = []
    for c in numeric:
        v = F.col(f"`{c}`").cast("double")
        q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
        rows.append(
            df.agg(
                F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"), q.alias("_q"), F.max(v).alias("max"),
            ).select(
                F.lit(c).alias("column"), "count", "mean", "std", "min",
                F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max",
            )
        )
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, std, min, exact 25/50/75 % and max of each numeric
    column (one row per column, values as double).

    Percentiles are exact with linear interpolation, selected in a few passes over
    all columns together, so no aggregation buffer ever holds a whole column and
    nothing is sorted; the passes run when the function is called.  With
    ``exact=False`` the quartiles come from a quantile sketch in one pass.
    Time columns beside numbers are described with them (``describe_mixed``);
    without numeric columns the time columns alone (``describe_time``), and
    without those the text columns (``describe_text``).
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numeric = [f.name for f in fields if isinstance(f.dataType, _NUMERIC)]
    times = [f.name for f in fields if isinstance(f.dataType, _TIME)]
    if not numeric:
        # As pandas: time columns when there is no number, else text statistics.
        if times:
            return describe_time(df, times)
        return describe_text(df, [f.name for f in fields])
    if not exact:
        return describe_approx(df, numeric)
    if times:
        return describe_mixed(df, [f.name for f in fields])
    stats = _described(df, {c: _present(df, c) for c in numeric})
    schema = "column string, count bigint, " + ", ".join(f"{x} double" for x in STATS)
    return df.sparkSession.createDataFrame([(c, *stats[c]) for c in numeric], schema)


def _back(x: str):
    return from_micros(F.round(F.col(x)).cast("bigint"))


def describe_time(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A9 for time columns: count, mean, min, quartiles, max as UTC wall clocks."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    times = [f.name for f in fields if isinstance(f.dataType, _TIME)]
    if not times:
        raise ValueError("no time column to describe")
    stats = _described(df, {c: _micros(df, c) for c in times})
    schema = "column string, count bigint, " + ", ".join(f"{x} double" for x in STATS)
    rows = df.sparkSession.createDataFrame([(c, *stats[c]) for c in times], schema)
    return rows.select("column", "count", *[_back(x).alias(x) for x in STATS if x != "std"])


def describe_mixed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A9 for frames with numbers and times, in the frame's order of columns, as
    pandas lists both: ``column, kind`` (``number`` or ``time``), ``count``, the
    statistics of numbers as doubles, and those of times as UTC wall clocks in columns
    that end in ``_at`` (times have no ``std``).  All columns share the same passes."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    kinds = {f.name: "time" if isinstance(f.dataType, _TIME) else "number" for f in fields if isinstance(f.dataType, _NUMERIC + _TIME)}
    stats = _described(df, {c: _micros(df, c) if k == "time" else _present(df, c) for c, k in kinds.items()})
    schema = "column string, kind string, count bigint, " + ", ".join(f"{x} double" for x in STATS)
    rows = df.sparkSession.createDataFrame([(c, k, *stats[c]) for c, k in kinds.items()], schema)
    number = F.col("kind") == "number"
    return rows.select(
        "column", "kind", "count", *[F.when(number, F.col(x)).alias(x) for x in STATS],
        *[F.when(~number, _back(x)).alias(f"{x}_at") for x in STATS if x != "std"],
    )


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A9 for text columns: count, unique, top (most frequent; ties: the
    smallest value) and its frequency."""
    out = None
    for c in columns:
        col = F.col(f"`{c}`").cast("string")
        freq = df.where(col.isNotNull()).groupBy(col.alias("v")).agg(F.count(F.lit(1)).alias("n"))
        # Ties on the count go to the smallest value: order by (n desc, v asc).
        best = freq.agg(
            F.sum("n").alias("count"),
            F.count("v").alias("unique"),
            F.min_by("v", F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("top"),
            F.max("n").alias("freq"),
        )
        part = best.select(F.lit(c).alias("column"), "count", "unique", "top", "freq")
        out = part if out is None else out.unionByName(part)
    return out
