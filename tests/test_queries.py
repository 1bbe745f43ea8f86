"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import catalog
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# No row is handed to Python, and nothing is joined without a key ...
FORBIDDEN = ("EvalPython", "InPandas", "InArrow", "CartesianProduct")
# ... but for the question whether a duplicate exists at all: one row or none.
ONE_ROW_CHECK = ("dedup_collapse", "dedup_keep_null_keys", "feed_to_table")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN if n in plan]
    assert "NestedLoopJoin" not in plan or name in ONE_ROW_CHECK
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
