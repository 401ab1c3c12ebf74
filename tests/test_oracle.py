"""Every registered query against its DuckDB oracle at sf0.01 (order-insensitive)."""

import os

import pytest

from __spark_entry__ import entry
from propyield.plans.catalog import REGISTRY
from tests.oracle_check import compare, duck

SF_DIR = os.environ.get("PROPYIELD_ORACLE_SF", "/root/testdata/sf0.01")
SQL = {n: q.sql for n, q in REGISTRY.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, REGISTRY[name].run, SQL[name], SF_DIR)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[0] == "dep" and len(df.columns) == 8
    assert df.count() >= 0
