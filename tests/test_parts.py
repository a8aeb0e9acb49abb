"""Part extraction on literal documents."""

import json

from tracelake.operators.parts import export_parts, part_rejects, join_source, sessions_table
from tracelake.schemas import PART_COLUMNS, SESSION_COLUMNS

DOCS = {
    "bad": "{bad",
    "unknown": '{"type":"weird","text":"x"}',
    "notype": '{"text":"x"}',
    "text": '{"type":"text","text":"hello"}',
    "reason": '{"type":"reasoning","text":"think","time":{"start":1,"end":2}}',
    "reason_notime": '{"type":"reasoning","text":"think"}',
    "tool_nostate": '{"type":"tool","tool":"bash"}',
    "tool_nullstate": '{"type":"tool","tool":"bash","state":null}',
    "tool_strinput": '{"type":"tool","tool":"bash","state":{"status":"ok","input":"ls","output":"x"}}',
    "tool_objinput": '{"type":"tool","tool":"edit","state":{"status":"ok","input":{"a":1},"output":{"r":2}}}',
    "tool_nullinput": '{"type":"tool","tool":"read","state":{"status":"error","input":null,"output":null}}',
    "tool_noinput": '{"type":"tool","tool":"read","state":{"status":"running"}}',
    "patch_nofiles": '{"type":"patch"}',
    "patch_null": '{"type":"patch","files":null}',
    "patch_obj": '{"type":"patch","files":{"a":1}}',
    "patch_str": '{"type":"patch","files":"f.py"}',
    "patch_nullitem": '{"type":"patch","files":["a.py",null]}',
    "finish_notokens": '{"type":"step-finish","reason":"stop"}',
    "finish_zero": '{"type":"step-finish","reason":"stop","tokens":{"input":1,"output":2,"total":3},"cost":0}',
    "start": '{"type":"step-start"}',
}


def _source(spark, docs):
    part = spark.createDataFrame(
        [(pid, "m1", "s1", 1000 + i, 2000 + i, d) for i, (pid, d) in enumerate(docs.items())]
        + [("orphan_msg", "m-missing", "s1", 1, 1, DOCS["text"]), ("orphan_ses", "m1", "s-missing", 1, 1, DOCS["text"])],
        "id string, message_id string, session_id string, time_created bigint, time_updated bigint, data string",
    )
    message = spark.createDataFrame([("m1", '{"role":"assistant"}')], "id string, data string")
    session = spark.createDataFrame(
        [("s1", None, "slug", "/d", "/p", "T", "1", 1, 0, 5, 6)],
        "id string, parent_id string, slug string, directory string, path string, title string, version string, "
        "summary_additions bigint, summary_deletions bigint, time_created bigint, time_updated bigint",
    )
    return part, message, session


def test_extraction_cases(spark):
    rows = {r["part_id"]: r for r in export_parts(*_source(spark, DOCS)).collect()}
    assert set(rows) == set(DOCS)  # orphans dropped by the inner joins, bad JSON kept
    assert rows["bad"]["part_type"] is None and rows["bad"]["role"] == "assistant" and rows["bad"]["title"] == "T"
    assert rows["unknown"]["part_type"] == "weird" and rows["unknown"]["text"] is None
    assert rows["notype"]["part_type"] is None
    assert rows["text"]["text"] == "hello"
    assert json.loads(rows["reason"]["reasoning_time"]) == {"start": 1, "end": 2}
    assert rows["reason_notime"]["reasoning_time"] == "null"
    assert rows["tool_nostate"]["tool"] == "bash" and rows["tool_nostate"]["tool_status"] is None
    assert rows["tool_nostate"]["tool_input"] == "null"
    assert rows["tool_nullstate"]["tool_input"] == "null" and rows["tool_nullstate"]["tool_output"] is None
    assert rows["tool_strinput"]["tool_input"] == '"ls"' and rows["tool_strinput"]["tool_output"] == "x"
    assert json.loads(rows["tool_objinput"]["tool_input"]) == {"a": 1}
    assert json.loads(rows["tool_objinput"]["tool_output"]) == {"r": 2}
    assert rows["tool_nullinput"]["tool_input"] == "null" and rows["tool_nullinput"]["tool_output"] is None
    assert rows["tool_noinput"]["tool_input"] == "null" and rows["tool_noinput"]["tool_status"] == "running"
    assert rows["patch_nofiles"]["files"] == "[]"
    assert rows["patch_null"]["files"] == "null"
    assert json.loads(rows["patch_obj"]["files"]) == {"a": 1}
    assert rows["patch_str"]["files"] == '"f.py"'
    assert json.loads(rows["patch_nullitem"]["files"]) == ["a.py", None]
    assert rows["finish_notokens"]["reason"] == "stop" and rows["finish_notokens"]["tokens_total"] is None
    assert rows["finish_notokens"]["cost"] is None
    assert rows["finish_zero"]["cost"] == 0.0 and rows["finish_zero"]["tokens_total"] == 3
    assert rows["start"]["part_type"] == "step-start" and rows["start"]["files"] is None
    # columns of other types stay NULL
    assert rows["text"]["tool"] is None and rows["tool_strinput"]["text"] is None


def test_schema_and_rejects(spark):
    parts = export_parts(*_source(spark, DOCS))
    assert parts.columns == PART_COLUMNS
    rejects = part_rejects(join_source(*_source(spark, DOCS))).collect()
    assert [r["part_id"] for r in rejects] == ["bad"]
    assert sessions_table(_source(spark, DOCS)[2]).columns == SESSION_COLUMNS


def test_duplicate_json_keys_keep_last(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        docs = {"dup": '{"type":"text","text":"a","text":"b"}'}
        row = export_parts(*_source(spark, docs)).where("part_id = 'dup'").first()
        assert row["text"] == "b"
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


def test_session_filter_before_parse(spark):
    part, message, session = _source(spark, DOCS)
    df = export_parts(part, message, session, session_id="s1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "session_id" in plan and "s1" in plan
    assert df.count() == len(DOCS)
