"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
import verify

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


def stays_native(df):
    """No cross join, and no row leaves the JVM."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert slow not in plan, slow


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    state, note, _ = verify.compare(spark, con, name, SF, stays_native)
    assert state in ("ok", "rows"), note


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
