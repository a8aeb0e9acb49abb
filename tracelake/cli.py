"""Command-line jobs, for ``spark-submit`` or ``python -m tracelake.cli``.

    export-logs           text logs -> Parquet (all, or one session: error when empty)
    export-conversations  part/message/session tables -> parts + sessions Parquet
    create-tables         create-once tables from exported Parquet, with row counts
    load                  add one load to a versioned table (idempotent per load id)
    history               load history of a versioned table
    sql                   one free SQL query, capped rows, JSON on stdout

Every job runs on the session the launcher provides; the library's SQL
settings are applied only where the session has none (``configure``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _spark() -> SparkSession:
    from tracelake.session import configure

    return configure(SparkSession.builder.appName("tracelake").getOrCreate())


def _print(obj) -> None:
    print(json.dumps(obj, ensure_ascii=False, default=str))


def export_logs(args) -> dict:
    from tracelake.sources import sinks
    from tracelake.sources.logs import read_text_logs

    spark = _spark()
    logs = read_text_logs(spark, args.input, session_id=args.session, strict=not args.lenient)
    if args.session:
        path = sinks.export_session(logs, args.session, f"{args.output}/sessions/{args.session}", column="session.id")
    else:
        path = sinks.write_table(logs, f"{args.output}/logs")
    return {"written": path}


def export_conversations(args) -> dict:
    from tracelake.operators.parts import export_parts, sessions_table
    from tracelake.sources import sinks
    from tracelake.sources.tables import read_source

    spark = _spark()
    part, message, session = read_source(spark, args.source, jdbc_url=args.jdbc_url)
    parts = export_parts(part, message, session, session_id=args.session)
    if args.session:
        path = sinks.export_session(parts, args.session, f"{args.output}/sessions/{args.session}_parts")
        return {"written": [path]}
    out = [
        sinks.write_table(parts, f"{args.output}/conversations/parts"),
        sinks.write_table(sessions_table(session), f"{args.output}/conversations/sessions"),
    ]
    return {"written": out}


def create_tables(args) -> dict:
    from tracelake.plans.tables import create_table_once, list_tables
    from tracelake.sources.tables import read_parts, read_sessions

    spark = _spark()
    bucket = None
    if args.bucket_by:
        column, _, n = args.bucket_by.partition(":")
        bucket = (column, int(n or 64))
    counts = {
        "parts": create_table_once(
            spark, args.db, "parts", read_parts(spark, args.parts), args.format, args.location, bucket
        ),
        "sessions": create_table_once(spark, args.db, "sessions", read_sessions(spark, args.sessions), args.format),
    }
    tables = [r["table"] for r in list_tables(spark, args.db).collect()]
    return {"rows": counts, "tables": tables}


def load(args) -> dict:
    from tracelake.plans.tables import upsert
    from tracelake.sources.tables import read_parts

    spark = _spark()
    upsert(args.table, read_parts(spark, args.input), args.load_id)
    return {"table": args.table, "load_id": args.load_id}


def history(args) -> dict:
    from tracelake.plans.tables import load_history

    spark = _spark()
    rows = [r.asDict() for r in load_history(spark, args.table).collect()]  # one row per load
    return {"loads": rows}


def sql(args) -> dict:
    from tracelake.plans.sqlapi import run_sql

    spark = _spark()
    res = run_sql(spark, args.query, max_rows=args.max_rows, with_total=args.total)
    return {"ok": True, "columns": res.columns, "rows": res.rows, "count": res.count,
            "total_rows": res.total_rows, "elapsed_ms": res.elapsed_ms}


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tracelake")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("export-logs")
    p.add_argument("--input", nargs="+", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--session")
    p.add_argument("--lenient", action="store_true", help="bad timestamps become NULL instead of failing")
    p.set_defaults(func=export_logs)

    p = sub.add_parser("export-conversations")
    p.add_argument("--source", help="folder with part/, message/, session/ Parquet tables")
    p.add_argument("--jdbc-url")
    p.add_argument("--output", required=True)
    p.add_argument("--session")
    p.set_defaults(func=export_conversations)

    p = sub.add_parser("create-tables")
    p.add_argument("--db", required=True)
    p.add_argument("--parts", required=True)
    p.add_argument("--sessions", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--location")
    p.add_argument("--bucket-by", help="store parts in buckets, e.g. session_id:64")
    p.set_defaults(func=create_tables)

    p = sub.add_parser("load")
    p.add_argument("--table", required=True)
    p.add_argument("--input", required=True)
    p.add_argument("--load-id", type=int, required=True)
    p.set_defaults(func=load)

    p = sub.add_parser("history")
    p.add_argument("--table", required=True)
    p.set_defaults(func=history)

    p = sub.add_parser("sql")
    p.add_argument("--query", required=True)
    p.add_argument("--max-rows", type=int, default=2000)
    p.add_argument("--total", action="store_true", help="also count all rows (computes the whole result)")
    p.set_defaults(func=sql)
    return ap


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    try:
        _print(args.func(args))
    except Exception as exc:  # report like the SQL service did: ok=false + message
        _print({"ok": False, "error": str(exc)})
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
