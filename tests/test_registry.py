"""Every registered query against DuckDB, and the shape of its plan."""

from __future__ import annotations

import os
import re

import pytest
from compare import connect, difference

import __spark_entry__ as registry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
# The training-data queries have tests of their own, beside their subpackage.
OTHERS = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in registry.queries().items() if not OTHERS.match(name)}
ORACLE = {name: text for name, text in registry.oracle_sql().items() if not OTHERS.match(name)}
ROWS_ONLY: set[str] = set()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")


@pytest.fixture(scope="module")
def link():
    return connect(FOLDER)


def test_every_query_has_sql_unless_named():
    assert set(ORACLE) == set(QUERIES) - ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, link, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in plan
    assert difference(frame, link, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert registry.entry(spark).columns == QUERIES["payments_top_customers"](spark, FOLDER).columns
