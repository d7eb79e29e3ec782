"""Every registered query equals its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import pytest

from tools.compare import connect, problems
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    """The plan also pairs no rows without a key and leaves the JVM nowhere."""
    result = QUERIES[name](spark, SF_DIR)
    count, found = problems(con, result, ORACLE_SQL[name])
    assert not found
    assert count > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"):
        assert node not in plan
