"""Registered queries against their SQL forms on a second engine."""

import os

import compare
import pytest

import __spark_entry__ as registry
from wicketflow.plans import catalogue, oracles

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
NAMES = sorted(catalogue.queries())


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_a_sql_form():
    """Those of the pipeline operators, which are checked in their own tests, aside."""
    assert set(catalogue.queries()) == set(oracles.oracles())
    assert set(QUERIES) >= set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare.difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["innings_id", "batting_team", "total_runs", "total_wickets", "run_rate"] and df.count() > 0
