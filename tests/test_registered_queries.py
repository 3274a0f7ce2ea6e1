"""Every registered query against its SQL text on the smallest tables."""

import pytest
from conftest import SF
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 3


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
