"""The near-duplicate stage's last join: ids that go are broadcast if they are
few; of more, only texts that may go are shuffled."""

import pytest

from tracelake.llm import neardup

SCHEMA = "doc_id long, text string, n int"
LINE = "one two three four five six seven eight nine ten"


@pytest.fixture()
def no_small_joins(spark):
    """Joins that nobody asked to broadcast are shuffled, as with large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_of_class_by_broadcast_and_by_join(spark, no_small_joins):
    texts = [LINE, LINE, None, "other words altogether in this one here", LINE, ""]
    docs = spark.createDataFrame([(i if i != 4 else None, t, i) for i, t in enumerate(texts)], SCHEMA).repartition(2)
    for limit in (10, 0):
        kept = neardup.keep_first(docs, limit=limit)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (limit == 0) and "BroadcastHashJoin" in plan
        assert sorted(r["n"] for r in kept.collect()) == [0, 2, 3, 4, 5]
