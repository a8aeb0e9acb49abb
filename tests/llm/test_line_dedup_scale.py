"""What the line steps move and leave behind: texts are shuffled only where they
may have a partner, tables between the steps go."""

from pathlib import Path

import pytest

from tracelake.llm import linededup
from tracelake.llm.common import among
from tracelake.session import shared_dir

SCHEMA = "doc_id long, text string, n int"
LINE = "one two three four five six seven eight nine ten"
ROWS = [(i, f"{LINE} {i}\nown {i} words {i * i} here\n \n", i) for i in range(40)]
ROWS += [(None, LINE, 40), (41, None, 41), (42, " \t\n\r\n", 42), (43, f"{LINE} 3 {LINE}", 43), (44, f"{LINE} 3\n\u2003\nx", 44)]


@pytest.fixture()
def no_small_joins(spark):
    """Joins that nobody asked to broadcast are shuffled, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shared(spark, pattern):
    return set(Path(shared_dir(spark).removeprefix("file:")).rglob(pattern))


def test_among_keeps_every_member_and_splits(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, i % 3) for i in range(3000)], "a long, b int")
    keys = spark.createDataFrame([(i, i % 3) for i in range(0, 3000, 50) if i % 7] + [(None, 2)], "x long, y int")
    members = {tuple(r) for r in keys.collect()}
    for words in (1_000_000, 4, 1):
        here = among(rows, ["a", "b"], keys, words=words).collect()
        rest = among(rows, ["a", "b"], keys, "left_anti", words=words).collect()
        assert len(here) + len(rest) == 3000 and not members & {tuple(r) for r in rest}
        assert members <= {tuple(r) for r in here} and (words < 1_000_000 or len(here) < 1000)
    assert among(rows, ["a", "b"], keys.limit(0)).count() == 0 and among(rows, ["a", "b"], keys.limit(0), "left_anti").count() == 3000


def test_lines_leave_one_table_and_move_only_changed_texts(spark, no_small_joins):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    cuts, tables = _shared(spark, "rdd-*"), _shared(spark, "table-*")
    found = linededup.dropped_lines(docs)
    assert not _shared(spark, "rdd-*") - cuts and len(_shared(spark, "table-*") - tables) == 1
    got = {r["doc_id"]: (r["n_lines"], r["dropped"]) for r in found.collect()}
    # the null id comes first; all the others' first lines are one word longer
    assert got == {**{i: (2, [0]) for i in range(40)}, None: (1, []), 43: (1, []), 44: (3, [0])}
    kept = linededup.drop_lines(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan  # other texts go by the join with what was found
    want = {n: t if n >= 40 else t.split("\n", 1)[1] for _, t, n in ROWS}
    assert {r["n"]: r["text"] for r in kept.collect()} == want | {44: "\u2003\nx"}
