"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import ORACLE
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    assert difference(QUERIES[name](spark, folder), database, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
