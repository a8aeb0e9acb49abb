"""The command-line jobs, run in-process on the test session."""

import json

from tracelake import cli
from tracelake import fixtures as fx
from tracelake.sources import sinks


def _run(capsys, argv):
    code = cli.main(argv)
    out = capsys.readouterr().out.strip().splitlines()[-1]
    return code, json.loads(out)


def test_jobs_end_to_end(spark, scratch, capsys):
    root = scratch("cli")
    lines = [
        "timestamp=2024-01-01T10:00:00Z level=info session.id=s1 message=\"a b\"",
        "timestamp=2024-01-01T11:00:00Z level=warn session.id=s2",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/log")
    code, out = _run(capsys, ["export-logs", "--input", f"{root}/log", "--output", f"{root}/out"])
    assert code == 0 and spark.read.parquet(out["written"]).count() == 2
    code, out = _run(capsys, ["export-logs", "--input", f"{root}/log", "--output", f"{root}/out", "--session", "s1"])
    assert code == 0 and spark.read.parquet(out["written"]).count() == 1
    code, out = _run(capsys, ["export-logs", "--input", f"{root}/log", "--output", f"{root}/out", "--session", "nope"])
    assert code == 1 and out["ok"] is False

    part, message, session = fx.fx_source(spark, "/root/testdata/sf0.001")
    for name, df in (("part", part), ("message", message), ("session", session)):
        sinks.write_table(df, f"{root}/src/{name}")
    code, out = _run(capsys, ["export-conversations", "--source", f"{root}/src", "--output", f"{root}/lake"])
    assert code == 0
    n_parts = spark.read.parquet(f"{root}/lake/conversations/parts").count()
    code, out = _run(capsys, ["create-tables", "--db", "tl_cli", "--parts", f"{root}/lake/conversations/parts",
                              "--sessions", f"{root}/lake/conversations/sessions", "--location", f"{root}/wh"])
    assert code == 0 and out["rows"]["parts"] == n_parts and set(out["tables"]) >= {"parts", "sessions"}
    code, out = _run(capsys, ["sql", "--query", "SELECT part_type, count(*) AS n FROM tl_cli.parts GROUP BY 1 ;",
                              "--total"])
    assert code == 0 and out["columns"] == ["part_type", "n"] and out["total_rows"] == out["count"]
    code, out = _run(capsys, ["load", "--table", f"{root}/versions", "--input", f"{root}/lake/conversations/parts",
                              "--load-id", "0"])
    assert code == 0
    code, out = _run(capsys, ["history", "--table", f"{root}/versions"])
    assert code == 0 and out["loads"][0]["rows"] == n_parts and out["loads"][0]["operation"] == "append"


def test_export_one_session(spark, scratch, capsys):
    root = scratch("cli-one")
    part, message, session = fx.fx_source(spark, "/root/testdata/sf0.001")
    for name, df in (("part", part), ("message", message), ("session", session)):
        sinks.write_table(df, f"{root}/src/{name}")
    code, out = _run(capsys, ["export-conversations", "--source", f"{root}/src", "--output", f"{root}/lake",
                              "--session", "s1"])
    assert code == 0
    written = spark.read.parquet(out["written"][0])
    assert written.count() > 0 and {r["session_id"] for r in written.select("session_id").distinct().collect()} == {"s1"}
    code, out = _run(capsys, ["export-conversations", "--source", f"{root}/src", "--output", f"{root}/lake",
                              "--session", "no-such-session"])
    assert code == 1 and "no rows" in out["error"]
