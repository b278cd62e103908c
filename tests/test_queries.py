"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from millrace import queries as tables
from tests.compare import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = tables.registered(), tables.oracles()  # those on training text have tests of their own


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan
    if name in SQL:
        assert compare(frame, FOLDER, SQL[name]) == ""
    else:
        assert frame.columns and frame.count() >= 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
