"""Every registered query against its SQL over the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry._registry().ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(entry._registry().QUERIES) == set(entry._registry().ORACLES)


def test_entry_gives_rows(spark):
    assert not entry.entry(spark).isEmpty()
