"""Proof queries: one per operator group of the inventory.

Each function takes ``(spark, sf_dir)``, reads the driver's tables (through
the adapters of ``fixtures``) and returns a lazy DataFrame whose column names
and types match the oracle SQL in ``tracelake.oracle``.  Result conventions
for the comparison: counts are bigint, money is summed as exact decimals and
returned as double, timestamps are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import fixtures as fx
from tracelake.functions.scalars import epoch_ms, hour_floor, lenient_double, to_ts
from tracelake.operators import counts, files, tools
from tracelake.operators import overview as ov
from tracelake.operators import parts as parts_ops
from tracelake.operators import sessions as sess
from tracelake.operators import timeline as tl
from tracelake.plans import sketches, sqlapi, sqlfuncs, tables
from tracelake.plans.ordering import with_position
from tracelake.schemas import PARTS
from tracelake.session import scratch_path, shared_dir
from tracelake.sources import logs as log_src
from tracelake.sources import sinks
from tracelake.sources import tables as tbl_src
from tracelake.streaming import jobs as streams


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return ov.valid_logs(fx.fx_logs(spark, sf))


# ---------------------------------------------------------------- overview


def q_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Events per hour of the valid logs."""
    return ov.hourly_activity(_valid(spark, sf))


def q_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Events per level, NULL under a label."""
    return ov.level_counts(_valid(spark, sf))


def q_lenient_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """lenient text-to-number parsing of the cost field."""
    logs = fx.fx_logs(spark, sf)
    return logs.select(F.col("cost").alias("cost_text"), lenient_double("cost").alias("cost_value"))


def q_dst_times(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch times, zoned text and hours around both changes of
    summer time, in a session whose zone has it."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        eid = F.col("event_id")
        change = F.when(eid % 2 == 0, 1710054000000).otherwise(1730613600000)
        ms = (change + (eid * 61 % 720 - 360) * 60000).cast("bigint")
        out = fx.table(spark, sf, "events").select("event_id", epoch_ms(ms).alias("dt"))
        out = out.withColumn("text_dt", to_ts(F.concat(F.replace(F.col("dt").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))))
        return out.withColumn("hour", hour_floor("text_dt"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def q_tokens_long(spark: SparkSession, sf: str) -> DataFrame:
    """Token sums per session, melted to long form."""
    return ov.tokens_long(ov.tokens_per_session(_valid(spark, sf)))


def q_top_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """The ten busiest sessions."""
    return ov.top_sessions(_valid(spark, sf), k=10)


def q_cumulative_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Running cost over time, distributed."""
    out = ov.cumulative_cost(_valid(spark, sf))
    return out.select("timestamp", F.col("cost").cast("double").alias("cost"),
                      F.col("cumulative").cast("double").alias("cumulative"))


def q_cumulative_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Running cost where a third of the rows are equal."""
    out = ov.cumulative_cost(fx.fx_equal_costs(spark, sf).withColumn("timestamp", to_ts("timestamp")))
    return out.select("timestamp", F.col("cost").cast("double").alias("cost"),
                      F.col("cumulative").cast("double").alias("cumulative"))


def q_load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, columns and files of a loaded log table."""
    return ov.load_metrics(fx.fx_logs(spark, sf, with_filename=True))


def _round6(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_describe(spark: SparkSession, sf: str) -> DataFrame:
    """Column statistics with exact quartiles (numeric columns)."""
    events = fx.table(spark, sf, "events")
    out = ov.describe(events, ["event_id", "user_id", "value"])
    return _round6(out, {"mean", "std", "min", "p25", "p50", "p75", "max"})


def q_describe_time(spark: SparkSession, sf: str) -> DataFrame:
    """Column statistics of a time column."""
    return ov.describe_time(fx.table(spark, sf, "events"), ["ts"])


def q_describe_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and times of one frame, described together."""
    out = ov.describe(fx.table(spark, sf, "events"))
    return _round6(out, {"mean", "std", "min", "p25", "p50", "p75", "max"})


def q_describe_text(spark: SparkSession, sf: str) -> DataFrame:
    """Count, unique, top and frequency of text columns."""
    return ov.describe_text(fx.table(spark, sf, "events"), ["event_type", "props"])


# ---------------------------------------------------------- conversations


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fx_parts(spark, sf)


def _whole_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of all messages, with whole tool texts."""
    return fx.fx_parts(spark, sf, whole=True)


def q_whole_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The typed parts of all messages, texts whole."""
    return _whole_parts(spark, sf)


def q_whole_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Display rows whose tool outputs are cut at 4,000 characters."""
    return tl.timelines(_whole_parts(spark, sf), n=tl.DEFAULT_N)


def q_tool_calls_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """O3 P5: all tool calls, with their place in the order."""
    calls = tools.tool_calls(_whole_parts(spark, sf))
    return with_position(calls, ["time_created", "part_id"], "pos")


def q_session_summary_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """The session summary over all messages, with each session's place."""
    out = sess.session_summary(fx.fx_sessions(spark, sf), _whole_parts(spark, sf))
    ranked = with_position(out, [F.desc_nulls_last("dt"), "id"], "pos")
    return ranked.select("id", "dt", "nb_parts", "nb_messages", F.col("cost").cast("double").alias("cost"), "pos")


def q_export_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """One session's parts, filtered before any JSON is parsed."""
    return parts_ops.export_parts(*fx.fx_source(spark, sf, whole=True), session_id="s7")


def q_parts_join(spark: SparkSession, sf: str) -> DataFrame:
    """Part -> message -> session inner joins."""
    joined = parts_ops.join_source(*fx.fx_source(spark, sf))
    return joined.select(F.col("id").alias("part_id"), "message_id", "session_id", "title")


def q_parts_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The typed parts table."""
    return _parts(spark, sf)


def q_sessions_projection(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed session projection."""
    return parts_ops.sessions_table(fx.fx_sessions(spark, sf))


def q_session_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Per-session metrics left-joined to sessions (flagship)."""
    out = sess.session_summary(fx.fx_sessions(spark, sf), _parts(spark, sf))
    return out.select(
        "id", "title", "dt", "summary_additions", "summary_deletions", "nb_parts", "nb_tools", "nb_messages",
        F.col("cost").cast("double").alias("cost"), F.col("tokens").cast("bigint").alias("tokens"),
    )


def q_session_list(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions newest first, with labels and positions."""
    listed = sess.session_list(fx.fx_sessions(spark, sf))
    return with_position(listed, [F.desc("time_created"), F.col("id")], "pos").select("id", "label", "dt", "pos")


def q_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """The first parts of every session as display rows."""
    return tl.timelines(_parts(spark, sf), n=tl.DEFAULT_N)


def q_timeline_first(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the first three parts of every session (the limit binds)."""
    return tl.timelines(_parts(spark, sf), n=3).select("session_id", "part_id", "seq")


def q_tool_names(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct tool names."""
    return tools.tool_names(_parts(spark, sf))


def q_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Tool calls filtered by tool list and a session id frame."""
    parts = _parts(spark, sf)
    with_patches = parts.where(F.col("part_type") == "patch").select("session_id")
    return tools.tool_calls(parts, tools=["bash", "edit"], sessions=with_patches)


def q_files_touched(spark: SparkSession, sf: str) -> DataFrame:
    """One row per modified file."""
    return files.files_touched(_parts(spark, sf))


def q_files_total(spark: SparkSession, sf: str) -> DataFrame:
    """The number of files touched."""
    return files.files_total(files.files_touched(_parts(spark, sf)))


def q_files_per_title(spark: SparkSession, sf: str) -> DataFrame:
    """Modified files per session title."""
    return files.files_per_title(files.files_touched(_parts(spark, sf)))


def q_files_per_session(spark: SparkSession, sf: str) -> DataFrame:
    """Modified files per session id."""
    return files.files_per_session(files.files_touched(_parts(spark, sf)))


def q_tool_call_count(spark: SparkSession, sf: str) -> DataFrame:
    """P5: the number of calls shown for a tool filter."""
    return tools.tool_call_count(_parts(spark, sf), tools=["bash", "read"])


def q_hot_files(spark: SparkSession, sf: str) -> DataFrame:
    """Most-touched files."""
    return files.hot_files(files.files_touched(_parts(spark, sf)))


def q_part_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts per (session, type), top 50."""
    return counts.part_type_counts(_parts(spark, sf), k=50)


def q_part_types(spark: SparkSession, sf: str) -> DataFrame:
    """Parts per type."""
    return counts.part_types(_parts(spark, sf))


def q_cost_per_message(spark: SparkSession, sf: str) -> DataFrame:
    """Cost and tokens per message."""
    out = sess.cost_per_message(_parts(spark, sf))
    return out.withColumn("cost", F.col("cost").cast("double"))


def q_logs_x_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Log events related to conversations."""
    return sess.logs_by_session(fx.fx_logs(spark, sf), fx.fx_sessions(spark, sf), _parts(spark, sf))


def q_logs_in_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Every log event with the part its session was at."""
    found = sess.logs_in_progress(fx.fx_session_logs(spark, sf), _parts(spark, sf))
    return found.withColumnRenamed("session.id", "session_id")


# ------------------------------------------------------- sources and sinks


def q_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Text log lines written, read back and parsed strictly."""
    src = scratch_path(spark, "log-lines")
    fx.fx_log_lines(spark, sf).write.text(src)
    logs = log_src.read_text_logs(spark, src, strict=True)
    return logs.select(
        "timestamp", "level", F.col("`session.id`").alias("session_id"), "cost",
        F.col("extras")["message"].alias("message"), F.col("extras")["empty"].alias("empty"),
        F.col("extras")["dup"].alias("dup"),
    )


def q_log_parse_session(spark: SparkSession, sf: str) -> DataFrame:
    """Text log lines of one session, the others left out before parsing."""
    src = scratch_path(spark, "log-lines")
    fx.fx_log_lines(spark, sf).write.text(src)
    logs = log_src.read_text_logs(spark, src, session_id="s7", strict=True)
    return logs.select("timestamp", "level", F.col("`session.id`").alias("session_id"), "cost")


def q_log_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Names and types of the columns of a loaded log table, with the
    number of values that each holds."""
    logs = fx.fx_logs(spark, sf).drop("filename")
    filled = logs.select(*[F.count(f"`{c}`").alias(c) for c in logs.columns])
    values = filled.unpivot([], [f"`{c}`" for c in logs.columns], "column", "filled")
    return ov.schema_of(logs).join(values, "column").select(F.col("position").cast("bigint").alias("position"), "column", "type", "filled")


def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two Parquet files with different columns, unioned by name."""
    root = scratch_path(spark, "union")
    ev = fx.table(spark, sf, "events")
    sid = F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session.id")
    ev.where(F.col("event_id") % 2 == 0).select(F.col("ts").alias("timestamp"), F.col("event_type").alias("level"), sid) \
        .write.parquet(f"{root}/a")
    ev.where(F.col("event_id") % 2 == 1).select(F.col("ts").alias("timestamp"), sid, F.col("value").alias("cost")) \
        .write.parquet(f"{root}/b")
    logs = log_src.read_logs(spark, [f"{root}/a", f"{root}/b"])
    return logs.select(
        "timestamp", "level", F.col("`session.id`").alias("session_id"), "cost",
        F.regexp_extract("filename", r"/(a|b)/[^/]*$", 1).alias("file"),
    )


def q_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """One table in files that hold a column as int, as double and as text."""
    root = scratch_path(spark, "mixed")
    ev = fx.table(spark, sf, "events")
    eid = F.col("event_id")
    own = (F.concat(F.lit("p"), eid.cast("string")).alias("part_id"), F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"))
    n = (eid % 50).cast("int")
    ev.where(eid % 3 == 0).select(*own, n.alias("tokens_total")).write.mode("append").parquet(root)
    gap = F.when(eid % 7 == 0, F.lit(float("nan"))).otherwise(n.cast("double"))
    ev.where(eid % 3 == 1).select(*own, gap.alias("tokens_total"), F.col("value").alias("cost")).write.mode("append").parquet(root)
    text = F.when(eid % 7 == 0, F.lit("n/a")).otherwise(n.cast("string"))
    ev.where(eid % 3 == 2).select(*own, text.alias("tokens_total"), F.lit("text").alias("part_type")).write.mode("append").parquet(root)
    return tbl_src.read_parts(spark, root).select("part_id", "session_id", "part_type", "tokens_total", "cost")


def q_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the Parquet file catalogue of a folder, with the rows that the
    files of each table hold."""
    found = tbl_src.list_parquet(spark, sf)
    name = F.regexp_extract("key", r"^([a-z]+)\.parquet(/|$)", 1)
    listed = found.groupBy(name.alias("table"), "kind").agg((F.sum("length") > 0).alias("has_bytes"))
    names = ("events", "documents", "conversations", "lineitem", "orders", "customer")
    rows = None
    for n in names:
        one = fx.table(spark, sf, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        rows = one if rows is None else rows.unionByName(one)
    return listed.join(rows, "table")


def q_inventory_rows(spark: SparkSession, sf: str) -> DataFrame:
    """S3: every table found in a folder, whatever its name, with its rows."""
    found = tbl_src.count_parquet(spark, sf)
    name = F.regexp_extract("key", r"^([^/]+)\.parquet(/|$)", 1)
    return found.groupBy(name.alias("table")).agg(F.sum("rows").alias("rows"))


def q_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written and read back."""
    path = sinks.write_table(_parts(spark, sf), scratch_path(spark, "parts"))
    return tbl_src.read_parts(spark, path, merge=False)  # written here with one schema


def q_source_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The conversation store written and read back as Parquet tables."""
    root = scratch_path(spark, "source")
    part, message, session = fx.fx_source(spark, sf)
    for name, df in (("part", part), ("message", message), ("session", session)):
        sinks.write_table(df, f"{root}/{name}")
    return parts_ops.export_parts(*tbl_src.read_source(spark, root))


def q_session_export(spark: SparkSession, sf: str) -> DataFrame:
    """Every session's parts in its own directory, read back."""
    path = sinks.export_all_sessions(_parts(spark, sf), scratch_path(spark, "by-session"))
    return tbl_src.read_parts(spark, path, merge=False)  # written here with one schema


def q_session_export_one(spark: SparkSession, sf: str) -> DataFrame:
    """One session's parts in their own location; a session without
    parts is an error."""
    parts = _parts(spark, sf)
    path = sinks.export_session(parts, "s1", scratch_path(spark, "one-session"))
    try:
        sinks.export_session(parts, "s-empty-0", scratch_path(spark, "no-session"))
    except sinks.EmptyExport:
        return tbl_src.read_parts(spark, path, merge=False)
    raise AssertionError("the export of a session without parts did not fail")


def q_session_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """All sessions in a fixed number of bucket folders, read back."""
    path = sinks.export_session_buckets(_whole_parts(spark, sf), scratch_path(spark, "buckets"), buckets=16)
    return tbl_src.read_parts(spark, path, merge=False)


def q_session_from_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """One session, read from its bucket alone."""
    path = sinks.export_session_buckets(_whole_parts(spark, sf), scratch_path(spark, "buckets"), buckets=16)
    return tbl_src.read_session(spark, path, "s1")


def q_ctas_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Create-once table, second run a no-op."""
    db = "tl_" + scratch_path(spark, "db").rsplit("-", 1)[-1]
    loc = scratch_path(spark, "warehouse")
    parts = _parts(spark, sf)
    n1 = tables.create_table_once(spark, db, "parts", parts, location=loc)
    n2 = tables.create_table_once(spark, db, "parts", parts.limit(0), location=loc)
    if n1 != n2 or tables.list_tables(spark, db).where(F.col("table") == "parts").count() != 1:
        raise AssertionError("create-once table changed on the second run")
    return spark.table(f"`{db}`.`parts`")


# ------------------------------------------------------------------ SQL


def _views(spark: SparkSession, sf: str) -> None:
    sqlapi.register_views(
        spark,
        {
            "parts": _parts(spark, sf),
            "sessions": fx.fx_sessions(spark, sf),
            "logs": fx.fx_logs(spark, sf),
        },
    )


def q_sql_explorer(spark: SparkSession, sf: str) -> DataFrame:
    """Free SQL over the registered views."""
    _views(spark, sf)
    return sqlapi.sql_frame(
        spark, "SELECT part_type, count(*) AS n FROM parts GROUP BY part_type ORDER BY n DESC, part_type ;  "
    )


def q_sql_result_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Free SQL over a stored table, capped rows."""
    # Q2: free SQL over a persisted (create-once) table, capped at MAX_ROWS.
    db = "tl_" + scratch_path(spark, "sqldb").rsplit("-", 1)[-1]
    tables.create_table_once(spark, db, "lineitem", fx.table(spark, sf, "lineitem"),
                             location=scratch_path(spark, "sqlwh"))
    return sqlapi.sql_frame(
        spark,
        f"SELECT l_orderkey, l_linenumber, l_quantity FROM `{db}`.lineitem ORDER BY l_orderkey, l_linenumber;",
        max_rows=sqlapi.MAX_ROWS,
    )


def q_sql_total(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of a result and the number of all, from one run."""
    sqlapi.register_views(spark, {"line_items": fx.table(spark, sf, "lineitem")})
    res = sqlapi.run_sql(
        spark, "SELECT l_orderkey, count(*) AS n FROM line_items GROUP BY 1 ORDER BY n DESC, l_orderkey;", max_rows=100, with_total=True
    )
    rows = [(i + 1, *row, res.total_rows) for i, row in enumerate(res.rows)]
    return spark.createDataFrame(rows, "pos bigint, l_orderkey bigint, n bigint, total bigint")


def _sql_with_functions(spark: SparkSession, sf: str, query: str) -> DataFrame:
    sqlapi.register_views(spark, {
        "parts": _whole_parts(spark, sf), "sessions": fx.fx_sessions(spark, sf), "logs": fx.fx_logs(spark, sf),
    })
    sqlfuncs.register_functions(spark)
    return sqlapi.sql_frame(spark, query)


def q_sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Lenient times and numbers in SQL text alone."""
    return _sql_with_functions(spark, sf, """
        SELECT hour_of(lenient_time(`timestamp`)) AS hour, count(*) AS count, sum(lenient_number(`tokens.input`)) AS tokens
        FROM logs WHERE lenient_time(`timestamp`) IS NOT NULL GROUP BY 1;""")


def q_sql_timelines(spark: SparkSession, sf: str) -> DataFrame:
    """The timelines as a table function."""
    return _sql_with_functions(spark, sf, "SELECT * FROM timelines(200)")


def q_sql_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """The session summary as a table function, with labels."""
    return _sql_with_functions(spark, sf, "SELECT session_label(title, id) AS label, * FROM session_summaries()")


def q_json_safe(spark: SparkSession, sf: str) -> DataFrame:
    """JSON-safe conversion of typed columns."""
    ev = fx.table(spark, sf, "events").select(
        "event_id",
        F.col("ts"),
        F.to_date("ts").alias("day"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("event_type").cast("binary").alias("raw"),
        F.array("user_id", "event_id").alias("ids"),
        F.create_map(F.col("user_id"), F.col("event_type")).alias("by_user"),
    )
    safe = sqlapi.json_safe(ev)
    return safe.select(
        "event_id", "ts", "day", "amount", "raw",
        F.to_json("ids").alias("ids"), F.to_json("by_user").alias("by_user"),
    )


# ----------------------------------------------------- versioned tables


def _load_frames(spark: SparkSession, sf: str) -> list[DataFrame]:
    # Three loads are cut from one parts table: compute it once and cut the
    # lineage (checkpoint in the shared folder) instead of re-deriving it per load.
    shared_dir(spark)
    return fx.fx_loads(_parts(spark, sf).checkpoint(eager=True))


def q_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of each part."""
    loads = _load_frames(spark, sf)
    rows = loads[0].unionByName(loads[1]).unionByName(loads[2])
    return tables.latest(rows, "part_id", ["time_updated"])


def _upserted(spark: SparkSession, sf: str) -> str:
    table_dir = scratch_path(spark, "loads")
    for n, frame in enumerate(_load_frames(spark, sf)):
        tables.upsert(table_dir, frame, n)
    return table_dir


def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads upserted, current state."""
    return tables.as_of(spark, _upserted(spark, sf), None)


def q_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads, each adding only what no load holds; two reruns, one
    under its own number and one under a new one, change nothing."""
    table_dir = scratch_path(spark, "inserts")
    loads = fx.fx_insert_loads(_parts(spark, sf).checkpoint(eager=True))
    for n, frame in enumerate([*loads, loads[1]]):
        added = tables.insert_only(table_dir, frame, n)
        if (added == 0) != (n == 3):
            raise AssertionError(f"load {n} added {added} rows")
    tables.insert_only(table_dir, loads[1], 1)
    return tables.read_loads(spark, table_dir).drop("loaded_at").withColumn(tables.LOAD, F.col(tables.LOAD).cast("bigint"))


def q_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table as of load 1."""
    return tables.as_of(spark, _upserted(spark, sf), 1)


def q_load_history(spark: SparkSession, sf: str) -> DataFrame:
    """One row per load."""
    return tables.load_history(spark, _upserted(spark, sf)).drop("committed_at")


def _sketched(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Three loads and their sketches."""
    table_dir, sketch_dir = _upserted(spark, sf), scratch_path(spark, "sketches")
    for n in range(3):
        sketches.write_sketches(spark, table_dir, sketch_dir, n, ["session_id", "message_id", "part_id"], ["tokens_total", "time_created"])
    return table_dir, sketch_dir


LOAD_RANGES = [(0, 0), (0, 1), (1, 2), (0, 2)]


def q_sketch_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sessions, messages and parts of ranges of loads, from
    sketches alone, against the exact counts."""
    table_dir, sketch_dir = _sketched(spark, sf)
    loads, out = tables.read_loads(spark, table_dir), None
    columns = ["session_id", "message_id", "part_id"]
    for a, b in LOAD_RANGES:
        rows = loads.where(F.col(tables.LOAD).between(a, b)).agg(*[F.count_distinct(c).alias(c) for c in columns])
        exact = rows.unpivot([], columns, "column", "exact")
        one = sketches.distinct_in_loads(spark, sketch_dir, columns, a, b).join(exact, "column")
        near = F.abs(F.col("estimate") - F.col("exact")) <= F.col("bound") * F.col("exact")
        one = one.select(F.lit(a).cast("bigint").alias("first"), F.lit(b).cast("bigint").alias("last"), "column", "exact", near.alias("within"))
        out = one if out is None else out.unionByName(one)
    return out


def q_sketch_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of ranges of loads from sketches alone; the error in rank
    is measured against all rows."""
    table_dir, sketch_dir = _sketched(spark, sf)
    loads, out = tables.read_loads(spark, table_dir), None
    for a, b in LOAD_RANGES:
        guess = sketches.quartiles_in_loads(spark, sketch_dir, ["tokens_total", "time_created"], a, b)
        rows = loads.where(F.col(tables.LOAD).between(a, b))
        values = rows.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in ("tokens_total", "time_created")
        ])).alias("x")).select("x.*").where(F.col("v").isNotNull())
        # the rows at or below and below the estimate: its rank lies between them
        ranks = guess.join(values, "column").groupBy("column", "fraction", "n", "bound").agg(
            F.count_if(F.col("v") <= F.col("estimate")).alias("upto"), F.count_if(F.col("v") < F.col("estimate")).alias("below"),
            F.count(F.lit(1)).alias("exact"),
        )
        want, slack = F.col("fraction") * F.col("n"), F.col("bound") * F.col("n") + 1
        near = (F.col("below") <= want + slack) & (F.col("upto") >= want - slack)
        one = ranks.select(
            F.lit(a).cast("bigint").alias("first"), F.lit(b).cast("bigint").alias("last"), "column", "fraction",
            F.col("exact").alias("n"), (near & (F.col("n") == F.col("exact"))).alias("within"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def q_partition_prune(spark: SparkSession, sf: str) -> DataFrame:
    """Parts partitioned by month, per-month counts."""
    path = tables.write_partitioned(_parts(spark, sf), scratch_path(spark, "by-month"), by="month")
    back = spark.read.parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("parts"), F.count_distinct("session_id").alias("sessions"))


def q_partition_month(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of one month, read from that month's directory alone."""
    path = tables.write_partitioned(_parts(spark, sf), scratch_path(spark, "by-month"), by="month")
    one = spark.read.parquet(path).where(F.col("month") == "2024-02")
    return one.select("part_id", "session_id", "month")


def q_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Old and new files read with today's schema."""
    root = scratch_path(spark, "evolved")
    parts = _parts(spark, sf)
    even = fx.turn_of("part_id") % 2 == 0
    old = parts.where(even).drop("files")
    for c in ("tokens_input", "tokens_output", "tokens_total"):
        old = old.withColumn(c, F.col(c).cast("int"))
    old.write.parquet(f"{root}/old")
    parts.where(~even).write.parquet(f"{root}/new")
    return tables.read_evolved(spark, [f"{root}/old", f"{root}/new"], PARTS)


# ------------------------------------------------------------ streaming


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental text-log ingest (second run adds nothing)."""
    root = scratch_path(spark, "stream-logs")
    lines = fx.fx_log_lines(spark, sf)
    lines.write.text(f"{root}/in")
    streams.run(streams.stream_logs(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    # A second run over the same input adds nothing (the checkpoint knows the files).
    streams.run(streams.stream_logs(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt"))
    logs = spark.read.parquet(f"{root}/out")
    return logs.select(
        "timestamp", "level", F.col("`session.id`").alias("session_id"), "cost",
        F.col("extras")["message"].alias("message"), F.col("extras")["empty"].alias("empty"),
        F.col("extras")["dup"].alias("dup"),
    )


def q_stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarked hourly counts on a stream."""
    root = scratch_path(spark, "stream-hourly")
    ev = fx.table(spark, sf, "events").select(F.col("ts").alias("timestamp"), "event_type")
    ev.write.parquet(f"{root}/in")
    src = spark.readStream.schema(ev.schema).parquet(f"{root}/in")
    streams.run(streams.write_stream(streams.stream_hourly(src, "timestamp"), f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


def q_stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts on a stream, with files that come long after their
    hours: none of their rows is lost."""
    root = scratch_path(spark, "stream-late")
    ev = fx.table(spark, sf, "events").select(F.col("ts").alias("timestamp"), "event_id")
    late = F.col("event_id") % 4 == 0
    for n, part in enumerate((ev.where(~late), ev.where(late))):
        part.write.parquet(f"{root}/in/{n}")
        src = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        streams.run(streams.write_stream(streams.stream_hourly_partial(src), f"{root}/out", f"{root}/ckpt"))
    return streams.read_hourly(spark, f"{root}/out")


def q_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated exports de-duplicated on a stream, one file a batch, the
    newest rows first."""
    root = scratch_path(spark, "stream-dedup")
    loads = _load_frames(spark, sf)[::-1]
    for n, frame in enumerate(loads):
        sinks.write_files(frame.withColumn("dt", epoch_ms("time_created")), f"{root}/in/load={n}")
    schema = spark.read.parquet(f"{root}/in/load=0").schema
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    deduped = streams.stream_dedup(streams.with_arrival(src.parquet(f"{root}/in")), "part_id")
    streams.run(streams.write_stream(deduped, f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out").select("part_id", "session_id", "part_type")


def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """T4: change log of exported versions, newest per part."""
    root = scratch_path(spark, "stream-upsert")
    for n, frame in enumerate(_load_frames(spark, sf)):
        frame.write.parquet(f"{root}/in/load={n}")
    streams.run(streams.stream_changelog(spark, f"{root}/in", f"{root}/log", f"{root}/ckpt"))
    streams.run(streams.stream_changelog(spark, f"{root}/in", f"{root}/log", f"{root}/ckpt"))
    log = spark.read.parquet(f"{root}/log")
    return tables.latest(log, "part_id", ["time_updated", "load_id"]).select(*PARTS.fieldNames())


# ---------------------------------------------------------------- registry


def registry() -> dict:
    return {name: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    fn = globals().get("q_session_summary", q_hourly)
    return fn(spark, sf)
