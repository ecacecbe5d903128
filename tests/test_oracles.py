"""Every registered query that SQL can express, against DuckDB on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    from checks.run import connect

    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, con, name):
    from checks.run import differences

    assert differences(queries()[name](spark, FOLDER), oracle_sql()[name], con) == []


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["vintage_q", "n", "bad_rate"] and df.count() > 0
