"""Every registered query against its SQL."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from conftest import SMALL
from martlet.registry import QUERIES
from oracle.sql import ORACLE as SQL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMALL) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["YearNumber", "QuarterName", "Revenue", "Items", "Orders"]
