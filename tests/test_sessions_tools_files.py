"""A5-A7, J2, J3, O1-O4, P4-P9, R2, X6-X8 on literal parts."""

from pyspark.sql import functions as F

from tracelake.operators import counts, files, sessions, timeline, tools
from tracelake.schemas import PARTS, SESSIONS


def _parts(spark, rows):
    full = []
    for r in rows:
        d = dict.fromkeys(PARTS.fieldNames())
        d.update(r)
        full.append(tuple(d[c] for c in PARTS.fieldNames()))
    return spark.createDataFrame(full, PARTS)


def _sessions(spark, ids):
    return spark.createDataFrame(
        [(i, None, "s", "/d", "/p", f"title {i}", "1", 1, 2, 1000 * n, 1000 * n + 1) for n, i in enumerate(ids)], SESSIONS
    )


P = [
    dict(part_id="p1", message_id="m1", session_id="s1", time_created=1, part_type="text", role="user", text="hi"),
    dict(part_id="p2", message_id="m1", session_id="s1", time_created=2, part_type="tool", tool="bash", tool_status="ok",
         tool_input='{"c":1}', tool_output="out"),
    dict(part_id="p3", message_id="m2", session_id="s1", time_created=3, part_type="step-finish", tokens_total=10, cost=0.25),
    dict(part_id="p4", message_id="m2", session_id="s1", time_created=4, part_type="step-finish", tokens_total=None, cost=None),
    dict(part_id="p5", message_id=None, session_id="s2", time_created=5, part_type="tool", tool=None),
    dict(part_id="p6", message_id="m3", session_id="s2", time_created=6, part_type="patch", files='["a.py","b.py"]'),
    dict(part_id="p7", message_id="m3", session_id="s2", time_created=7, part_type="patch", files="null"),
    dict(part_id="p8", message_id="m4", session_id=None, time_created=8, part_type="weird"),
    dict(part_id="p9", message_id="m4", session_id="s2", time_created=9, part_type="step-finish", tokens_total=0, cost=0.0),
]


def test_session_summary_left_join_and_zero_sums(spark):
    parts = _parts(spark, P)
    out = {r["id"]: r for r in sessions.session_summary(_sessions(spark, ["s1", "s2", "s3"]), parts).collect()}
    assert out["s3"]["nb_parts"] is None and out["s3"]["cost"] is None
    assert out["s1"]["nb_parts"] == 4 and out["s1"]["nb_tools"] == 1 and out["s1"]["nb_messages"] == 2
    assert float(out["s1"]["cost"]) == 0.25 and int(out["s1"]["tokens"]) == 10
    # s2: all costs NULL or 0 -> sum is 0, not NULL; NULL message id not counted
    assert float(out["s2"]["cost"]) == 0.0 and out["s2"]["nb_messages"] == 2
    ordered = [r["id"] for r in sessions.session_summary(_sessions(spark, ["s1", "s2", "s3"]), parts).collect()]
    assert ordered == ["s3", "s2", "s1"]


def test_tool_filters(spark):
    parts = _parts(spark, P)
    assert [r["tool"] for r in tools.tool_names(parts).collect()] == ["bash"]
    every = tools.tool_calls(parts).collect()
    assert [r["part_id"] for r in every] == ["p2", "p5"] and every[1]["tool"] == "?"
    assert [r["part_id"] for r in tools.tool_calls(parts, tools=["bash"]).collect()] == ["p2"]
    assert [r["part_id"] for r in tools.tool_calls(parts, sessions=["s2"]).collect()] == ["p5"]
    ids = spark.createDataFrame([("s1",)], "id string")
    assert [r["part_id"] for r in tools.tool_calls(parts, sessions=ids).collect()] == ["p2"]
    many = [f"x{i}" for i in range(1500)] + ["s1"]
    assert [r["part_id"] for r in tools.tool_calls(parts, sessions=many).collect()] == ["p2"]


def test_files(spark):
    parts = _parts(spark, P)
    touched = files.files_touched(parts).collect()
    assert sorted(r["file"] for r in touched) == ["a.py", "b.py"]
    assert files.files_per_title(files.files_touched(parts.withColumn("title", F.lit("T")))).first()["count"] == 2
    hot = files.hot_files(files.files_touched(parts)).collect()
    assert {r["file"]: (r["touches"], r["sessions"]) for r in hot} == {"a.py": (1, 1), "b.py": (1, 1)}


def test_timeline_kinds_and_limit(spark):
    parts = _parts(spark, P)
    t = timeline.timeline(parts, "s1", n=3).collect()
    assert [r["kind"] for r in t] == ["user", "tool", "step-finish"]
    assert t[1]["body"] == "bash · ok" and t[2]["body"] == "10 tokens · 0.25"
    all_sessions = timeline.timelines(parts, n=2).collect()
    assert {(r["session_id"], r["seq"]) for r in all_sessions} == {("s1", 1), ("s1", 2), ("s2", 1), ("s2", 2)}
    s2 = {r["part_id"]: r for r in timeline.timeline(parts, "s2").collect()}
    assert s2["p6"]["body"] == "a.py, b.py" and s2["p7"]["body"] == "" and s2["p9"]["body"] == "0 tokens · 0.0"


def test_counts_and_cost_per_message(spark):
    parts = _parts(spark, P)
    top = counts.part_type_counts(parts, k=1).collect()
    assert (top[0]["session_id"], top[0]["part_type"], top[0]["n"]) == ("s1", "step-finish", 2)
    cpm = {(r["session_id"], r["message_id"]): r for r in sessions.cost_per_message(parts).collect()}
    assert float(cpm[("s1", "m2")]["cost"]) == 0.25 and cpm[("s1", "m2")]["tokens"] == 10


def test_logs_by_session_keeps_both_sides(spark):
    logs = spark.createDataFrame([("s1",), ("s1",), ("sX",), (None,)], "`session.id` string")
    out = {r["session_id"]: r for r in sessions.logs_by_session(logs, _sessions(spark, ["s1", "s2"]), _parts(spark, P)).collect()}
    assert out["s1"]["log_events"] == 2 and out["s1"]["nb_parts"] == 4
    assert out["s2"]["log_events"] is None and out["sX"]["title"] is None


def test_filters_reach_the_parquet_scan(spark, scratch):
    from tracelake.sources.tables import read_parts

    path = scratch("pushdown")
    _parts(spark, P).write.parquet(path)
    parts = read_parts(spark, path, merge=False)
    calls = tools.tool_calls(parts, tools=["bash", "edit"])
    plan = calls._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(part_type), EqualTo(part_type,tool)" in plan
    assert "In(tool, [bash,edit])" in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert "text" not in scan.split("ReadSchema")[1]  # columns the result does not need are not read
    one = timeline.timeline(parts, "s1")
    assert "EqualTo(session_id,s1)" in one._jdf.queryExecution().executedPlan().toString()
    assert [r["part_id"] for r in one.collect()] == ["p1", "p2", "p3", "p4"]


def test_hot_files_approx_option(spark):
    parts = _parts(spark, P)
    exact = {r["file"]: r["sessions"] for r in files.hot_files(files.files_touched(parts)).collect()}
    approx = {r["file"]: r["sessions"] for r in files.hot_files(files.files_touched(parts), approx_distinct=True).collect()}
    assert exact == approx
