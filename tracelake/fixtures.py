"""Adapters that give the driver's tables the shape our operators read.

The driver ships TPC-H-like tables plus ``events`` and ``conversations``.
These functions derive, with plain DataFrame expressions, the inputs the
trace analyses expect: a ``logs`` table, raw ``key=value`` log lines, and the
``part`` / ``message`` / ``session`` tables of a conversation store.  The
oracle SQL repeats the same formulas as CTEs, so both engines see the same
rows.  Everything stays lazy and scales with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The base epoch of the synthetic conversation store
# (2024-01-01T00:00:00Z in ms) and the tools cycled through tool parts.
BASE_MS = 1704067200000
TOOLS = ["bash", "edit", "read"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


# ---------------------------------------------------------------- logs


def fx_logs(spark: SparkSession, sf_dir: str, with_filename: bool = False) -> DataFrame:
    """``logs`` rows (text-typed, as the log exporter stores them), with the
    source file in ``filename`` when asked (reading the file metadata column
    costs a little in every scan, so it is opt-in)."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    filename = F.col("_metadata.file_path") if with_filename else F.lit(None).cast("string")
    return e.select(
        F.when(eid % 101 == 0, F.lit("bad")).otherwise(_s(F.col("ts"))).alias("timestamp"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("level"),
        F.lit("event").alias("type"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("s"), _s(F.col("user_id"))))
        .alias("session.id"),
        F.when(eid % 11 == 0, F.lit("n/a")).otherwise(_s(eid % 50)).alias("tokens.input"),
        F.when(eid % 17 == 0, F.lit(None).cast("string")).otherwise(_s(eid % 70)).alias("tokens.output"),
        F.when(eid % 13 == 0, F.lit("n/a"))
        .when(eid % 29 == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.col("value")))
        .alias("cost"),
        filename.alias("filename"),
    )


def fx_session_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events during the conversations: a third of them in session ``s1``,
    a few before its first part, some without a session or a time."""
    eid = F.col("event_id")
    conv = F.when(eid % 3 == 0, F.lit(1)).otherwise(eid % 131)
    ms = F.lit(BASE_MS) + (conv * 1000 + eid % 13 - 2) * 60000 + eid % 5 * 1000
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(eid % 101 != 0, F.timestamp_add("MILLISECOND", ms.cast("bigint"), F.lit("1970-01-01").cast("timestamp_ntz"))).alias("timestamp"),
        F.col("event_type").alias("level"),
        F.when(eid % 97 != 0, F.concat(F.lit("s"), _s(conv))).alias("session.id"),
    )


def fx_equal_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log costs of which a third are one and the same row."""
    same = F.col("event_id") % 3 == 0
    return table(spark, sf_dir, "events").select(
        F.when(same, F.lit("2024-01-15T12:00:00")).otherwise(_s(F.col("ts"))).alias("timestamp"),
        F.when(same, F.lit("0.25")).otherwise(_s(F.col("value"))).alias("cost"),
    )


def fx_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``key=value`` log lines, one per event, in a ``value`` column."""
    e = table(spark, sf_dir, "events")
    ts = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    line = F.concat(
        F.lit("timestamp="), ts,
        F.lit(" level="), F.col("event_type"),
        F.lit(" session.id=s"), _s(F.col("user_id")),
        F.lit(" cost="), _s(F.col("value")),
        F.lit(' message="user '), _s(F.col("user_id")), F.lit(" did "), F.col("event_type"), F.lit('"'),
        F.lit(" empty= dup=1 dup=2"),
    )
    return e.select(line.alias("value"))


# ------------------------------------------------------ conversation store


def _part_json(whole: bool = False) -> F.Column:
    """JSON document of a part, by ``(conv_id + turn) % 6``."""
    output = F.array_join(F.array_repeat("text", 3), "\n") if whole else F.substring(F.col("text"), 1, 100)
    conv, turn = F.col("conv_id"), F.col("turn")
    kind = (conv + turn) % 6
    tool = F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (conv % 3 + 1).cast("int"))
    text = F.to_json(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    reasoning = F.to_json(
        F.struct(
            F.lit("reasoning").alias("type"),
            F.col("text").alias("text"),
            F.struct(turn.alias("start"), (turn + 1).alias("end")).alias("time"),
        )
    )
    tool_doc = F.to_json(
        F.struct(
            F.lit("tool").alias("type"),
            tool.alias("tool"),
            F.struct(
                F.lit("completed").alias("status"),
                F.struct(turn.alias("n")).alias("input"),
                output.alias("output"),
            ).alias("state"),
        )
    )
    finish = F.to_json(
        F.struct(
            F.lit("step-finish").alias("type"),
            F.lit("stop").alias("reason"),
            F.struct(
                (turn * 10).alias("input"), (turn * 3).alias("output"), (turn * 13).alias("total")
            ).alias("tokens"),
            (turn / 100.0).alias("cost"),
        )
    )
    patch = F.to_json(
        F.struct(
            F.lit("patch").alias("type"),
            F.array(
                F.concat(F.lit("src/f"), _s(conv % 7), F.lit(".py")),
                F.concat(F.lit("src/g"), _s(turn), F.lit(".py")),
            ).alias("files"),
        )
    )
    start = F.lit('{"type":"step-start"}')
    return (
        F.when(kind == 0, text)
        .when(kind == 1, reasoning)
        .when(kind == 2, tool_doc)
        .when(kind == 3, finish)
        .when(kind == 4, patch)
        .otherwise(start)
    )


def fx_part(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """One part per turn; tool outputs are the first 100 characters of the text
    or, with ``whole``, the whole text three times, so that some are longer than a
    display row shows."""
    c = table(spark, sf_dir, "conversations")
    created = F.lit(BASE_MS) + (F.col("conv_id") * 1000 + F.col("turn")) * 60000
    return c.select(
        F.concat(F.lit("p"), _s(F.col("conv_id")), F.lit("-"), _s(F.col("turn"))).alias("id"),
        F.concat(F.lit("m"), _s(F.col("conv_id")), F.lit("-"), _s(F.floor(F.col("turn") / 2).cast("bigint"))).alias(
            "message_id"
        ),
        F.concat(F.lit("s"), _s(F.col("conv_id"))).alias("session_id"),
        created.cast("bigint").alias("time_created"),
        (created + 1000).cast("bigint").alias("time_updated"),
        _part_json(whole).alias("data"),
    )


def fx_message(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """One row per message; unless ``whole``, messages of ``conv_id % 31 = 0`` are
    absent (parts without a message, for the joins)."""
    c = table(spark, sf_dir, "conversations")
    if not whole:
        c = c.where(F.col("conv_id") % 31 != 0)
    mid = F.concat(F.lit("m"), _s(F.col("conv_id")), F.lit("-"), _s(F.floor(F.col("turn") / 2).cast("bigint")))
    return (
        c.groupBy(mid.alias("id"))
        .agg(F.min("role").alias("role"))
        .select("id", F.to_json(F.struct(F.col("role"))).alias("data"))
    )


def fx_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``session`` table: one row per conversation plus three empty ones."""
    c = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    conv = F.col("conv_id")
    created = F.lit(BASE_MS) + conv * 60000000
    main = c.select(
        F.concat(F.lit("s"), _s(conv)).alias("id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit("slug").alias("slug"),
        F.lit("/work").alias("directory"),
        F.lit("/work").alias("path"),
        F.concat(F.lit("session "), _s(conv % 40)).alias("title"),
        F.lit("1.0.0").alias("version"),
        (conv % 5).cast("bigint").alias("summary_additions"),
        (conv % 3).cast("bigint").alias("summary_deletions"),
        created.cast("bigint").alias("time_created"),
        (created + 1000).cast("bigint").alias("time_updated"),
    )
    empty = spark.range(3).select(
        F.concat(F.lit("s-empty-"), _s(F.col("id"))).alias("id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit("slug").alias("slug"),
        F.lit("/work").alias("directory"),
        F.lit("/work").alias("path"),
        F.lit("empty").alias("title"),
        F.lit("1.0.0").alias("version"),
        F.lit(0).cast("bigint").alias("summary_additions"),
        F.lit(0).cast("bigint").alias("summary_deletions"),
        F.lit(BASE_MS).cast("bigint").alias("time_created"),
        F.lit(BASE_MS + 1000).cast("bigint").alias("time_updated"),
    )
    return main.unionByName(empty)


def fx_source(spark: SparkSession, sf_dir: str, whole: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx_part(spark, sf_dir, whole), fx_message(spark, sf_dir, whole), fx_sessions(spark, sf_dir)


def fx_parts(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """The exported ``parts`` table (J1 + F8-F10 over ``fx_source``)."""
    from tracelake.operators.parts import export_parts

    return export_parts(*fx_source(spark, sf_dir, whole))


# ----------------------------------------------------------------- loads


def turn_of(part_id: str) -> F.Column:
    """The turn number encoded in a fixture part id ``p<conv>-<turn>``."""
    return F.regexp_extract(F.col(part_id), r"-(\d+)$", 1).cast("bigint")


def fx_loads(parts: DataFrame) -> list[DataFrame]:
    """Three loads of ``parts``: load n holds the parts with ``turn % 3 = n``
    plus, for n > 0, the parts of load n-1 again, updated (``time_updated``
    + n*1000, `` (edited)`` appended to the text)."""
    turn = turn_of("part_id")
    loads = []
    for n in range(3):
        fresh = parts.where(turn % 3 == n)
        if n:
            again = parts.where(turn % 3 == n - 1).withColumn(
                "time_updated", F.col("time_updated") + n * 1000
            ).withColumn("text", F.concat(F.col("text"), F.lit(" (edited)")))
            fresh = fresh.unionByName(again)
        loads.append(fresh)
    return loads


def fx_insert_loads(parts: DataFrame) -> list[DataFrame]:
    """The loads of ``fx_loads`` with every row twice, and without a key where
    ``turn % 4 = 3``."""
    key = F.when(turn_of("part_id") % 4 != 3, F.col("part_id")).alias("part_id")
    return [
        (loose := f.select(*[key if c == "part_id" else F.col(c) for c in f.columns])).unionByName(loose) for f in fx_loads(parts)
    ]
