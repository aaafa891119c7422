"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from bindings.catalog import ORACLES, QUERIES
from check import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SMALL)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
