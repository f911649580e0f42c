"""Every registered query against DuckDB on the smallest tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_registry():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "thread_id" in df.columns


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert df.count() > 0
