"""Every registered query with SQL agrees with it on the small tables."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLE[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 6
