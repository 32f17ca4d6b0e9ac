"""Every named query of the core against its SQL counterpart in an independent engine."""

import pytest

import __spark_entry__ as entry_points
from compare_engines import connect, duck_rows, spark_rows
from ledgerlens.plans import catalogue, oracle

QUERIES = catalogue.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, sf, duck, name):
    names, records = spark_rows(QUERIES[name](spark, sf))
    expected_names, expected = duck_rows(duck, SQL[name])
    assert names == expected_names
    assert records == expected
    assert sum(records.values()) > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["card_id", "transactions"]
    assert df.count() > 0
