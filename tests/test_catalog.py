"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from verification import catalog
from verification.compare import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name]))
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
