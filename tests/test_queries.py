"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tidegate.plans.catalogue import QUERIES, SQL
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, FOLDER, QUERIES[name], SQL.get(name), con)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
