"""Every registered query against its oracle SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare(df, con, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
