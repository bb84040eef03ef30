"""Every registered query: equal to its SQL twin, or at least running."""

import importlib

import pytest

from check_oracle import compare, connect

ENTRY = importlib.import_module("__spark_entry__")
QUERIES, SQL = ENTRY.queries(), ENTRY.oracle_sql()
SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert ENTRY.entry(spark).count() == 10
