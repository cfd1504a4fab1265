"""Every registered query against its SQL, on whole tables."""

import pytest
from oracle import connect, differences

import __spark_entry__ as registry

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, QUERIES[name], SQL.get(name)) == []


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).limit(1).count() == 1
