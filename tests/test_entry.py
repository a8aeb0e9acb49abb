"""The driver contract: entry, queries and oracle at sf0.001 against DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, _close, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "nb_parts" in df.columns and "cost" in df.columns


def test_every_query_has_an_oracle_or_a_reason():
    rows_only = set()
    own = set(entry.queries()) - set(entry._llm("registry"))  # the optional part has its own tests
    assert own - set(entry.oracle_sql()) == rows_only
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry._llm("oracle"))))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sdf = df.toPandas()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    odf = con.execute(entry.oracle_sql()[name]).df()
    scols, srows = _rows(sdf)
    ocols, orows = _rows(odf)
    assert scols == ocols
    assert len(srows) == len(orows)
    for a, b in zip(srows, orows):
        assert all(_close(x, y) for x, y in zip(a, b)), (a, b)
