"""Every query beside its SQL on the smallest test tables, and the shape of every plan."""

import os

import pytest

import __spark_entry__ as entry_point
from oracle import compare, connect
from retailflow.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not mounted")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()  # the library's own; optional parts bring their tests


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert node not in plan
    assert compare(df, con, SQL[name]) is None


def test_every_query_has_sql_and_entry_runs(spark):
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())
    assert entry_point.entry(spark).columns[0] == "adjust_msku"
