"""Every corpus query that has SQL against an independent engine, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from compare_engines import connect, duck_rows, spark_rows

from ledgerlens.llm import queries

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(queries.queries())


@pytest.mark.parametrize("name", list(SQL))
def test_equal(spark, sf, duck, name):
    names, records = spark_rows(queries.queries()[name](spark, sf))
    expected_names, expected = duck_rows(duck, SQL[name])
    assert names == expected_names
    assert records == expected
    assert sum(records.values()) > 0


def test_a_second_scan_of_a_table_finds_its_ledger(spark, sf):
    query = queries.queries()["op5_secret_scans"]
    assert spark_rows(query(spark, sf)) == spark_rows(query(spark, sf))
