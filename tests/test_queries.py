"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__
from checks.compare import compare, connect
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection(small_tables):
    return connect(small_tables)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(__spark_entry__.queries()) & set(__spark_entry__.oracle_sql())


def test_entry_runs(spark, small_tables):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, small_tables, connection, name):
    same, note = compare(spark, connection, small_tables, name)
    assert same, note
