"""Plan checks for the scale claims of the README."""

from tracelake import fixtures as fx
from tracelake.operators import parts as parts_ops
from tracelake.operators import sessions, timeline

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_timeline_limits_before_the_shuffle(spark):
    plan = _plan(timeline.timelines(fx.fx_parts(spark, SF), n=3))
    final_plan = plan.split("== Initial Plan ==")[0]
    lines = [line.strip(" :+-") for line in final_plan.splitlines()]
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if line.startswith("Exchange hashpartitioning(session_id"))
    assert exchange < partial  # printed top-down: the partial limit sits below the exchange


def _walk(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _walk(children.apply(i))


def test_joins_never_move_json_documents(spark):
    part, message, session = fx.fx_source(spark, SF)
    out = parts_ops.export_parts(part, message, session)
    joins = [n for n in _walk(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    assert len(joins) == 2
    for join in joins:
        for i in range(join.children().size()):
            child = join.children().apply(i)
            names = {child.output().apply(j).name() for j in range(child.output().size())}
            assert "data" not in names and "_tl_doc" not in names, names


def test_session_metrics_aggregate_partially(spark):
    plan = _plan(sessions.session_metrics(fx.fx_parts(spark, SF)))
    assert "partial_count" in plan and "partial_sum" in plan
