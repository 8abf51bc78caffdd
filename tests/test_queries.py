"""Every named query against its SQL counterpart, on the smallest data set."""

import check
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert check.compare(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() == 44
    assert len(rows.columns) == 16
