"""Every registered query against its SQL twin, row by row."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from eventmill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.connection(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = compare.spark_rows(entry.queries()[name](spark, SMALL))
    assert got == compare.sql_rows(con, entry.oracle_sql()[name])
    assert got[1], "a query over the tables gives rows"


def test_entry(spark):
    assert entry.entry(spark).columns == ["index", "n"]
