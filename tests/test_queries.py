"""Every registered query at the smallest scale, against DuckDB where it has SQL."""

import os

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, db, key):
    df = QUERIES[key](spark, SF)
    if key in SQL:
        n, problems = check.compare(df, db, SQL[key])
        assert problems == []
    else:
        n = df.count()
    assert n > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
