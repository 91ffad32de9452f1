"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tillcheck.compare import compare, connect
from tillcheck.registry import all_queries

SF = "/root/testdata/sf0.001"
QUERIES = all_queries()  # the engine's own; what else is registered has tests of its own
SQL = {n: sql for n, sql in entry.oracle_sql().items() if n in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ok, note = compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "revenue", "previous_month_revenue", "growth_pct"]
    assert df.count() > 0
