"""Every registered query: its rows against its SQL on the small tables, and the shape of its plan."""

import pytest

import __spark_entry__ as contract
from catalog.queries import QUERIES, SQL
from compare import connect, differences

SF = "/root/testdata/sf0.001"
# One row per pass is put in order in one task.
GATHERED = {"pass_counts"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def check_plan(name, told):
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in told, unwanted
    lines = told.splitlines()
    for above, below in zip(lines, lines[1:]):
        # What meets in one task are sums of tasks, or a limit that was asked for.
        if "Exchange SinglePartition" in above and name not in GATHERED:
            assert "Aggregate" in below or "Limit" in below, below


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    frame = contract.queries()[name](spark, SF)
    check_plan(name, frame._jdf.queryExecution().executedPlan().toString())
    assert differences(frame, con, name) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["slug", "status", "builds_found", "message"] and frame.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(contract.oracle_sql())
