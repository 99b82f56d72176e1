"""Every registered query against its SQL, and the shape of its plan."""

import oracle
import pytest

import __spark_entry__ as entry_points
from tallywell.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert costly not in plan
    assert oracle.differences(df, tables, ORACLES[name]) is None


def test_entry(spark):
    assert set(ORACLES) == set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["sale_date", "product_id", "total_revenue"] and df.count() > 0
