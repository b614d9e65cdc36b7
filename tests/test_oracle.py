"""Every query with a SQL twin gives the same rows and types in DuckDB, on the smallest tables."""

import pytest

from compare import compare, connect, duck_result
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_twin_belongs_to_a_query():
    assert set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    table = queries()[name](spark, FOLDER).toArrow()
    assert compare(table, duck_result(duck, ORACLES[name])) == ""


def test_entry(spark):
    assert entry(spark).count() > 0
