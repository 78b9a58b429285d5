"""Every named query against its SQL on DuckDB, at the smallest scale."""

import pytest
from compare import connect, difference
from conftest import SF

import __spark_entry__ as entry
from estrato.catalog import REGISTRY

QUERIES = {name: run for name, run in entry.queries().items() if name in REGISTRY}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    assert difference(duck, QUERIES[name](spark, SF), SQL[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
