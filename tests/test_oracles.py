"""Every registered query against its checking SQL on the smallest tables."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry_points
from sparktide.plans.registry import REGISTRY

QUERIES = {name: run for name, run in entry_points.queries().items() if name in REGISTRY}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_orderkey"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) == []
