"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from siltlake.plans.registry import ORACLES, QUERIES
from conftest import SF
from oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
