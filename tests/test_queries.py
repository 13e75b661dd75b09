"""Every registered query against its SQL in DuckDB, and on the smallest data."""

import pytest

import __spark_entry__ as driver
from daylake.oracle import all_oracles
from daylake.registry import all_queries
from oracle_compare import SPARK_TO_DUCK, connect, duck_rows, duck_types, spark_rows

# Row-at-a-time or batched Python, and joins that pair everything with everything.
UNWANTED = ("Python", "ArrowEval", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")

# Listing a folder is a call to the store, made by tasks; no data goes through Python.
LISTS_FOLDERS = {"orphan_files", "retention_inventory"}

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    types = duck_types(duck, ORACLES[name])
    assert {c: SPARK_TO_DUCK[k] for c, k in result.dtypes} == types
    got, want = spark_rows(result), duck_rows(duck, ORACLES[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "the query should show at least one row"
    plan = result._jdf.queryExecution().executedPlan().toString()
    if name not in LISTS_FOLDERS:
        assert not [operator for operator in UNWANTED if operator in plan]


def test_entry(spark):
    assert driver.entry(spark).count() > 0
