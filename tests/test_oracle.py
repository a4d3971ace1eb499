"""Every registered query against its SQL in DuckDB."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as contract
from inkfold.catalog.registry import ORACLES, QUERIES
from tools.check_oracle import bag, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    """Of this package; the optional operators have tests of their own."""
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["date", "priority", "articles"]
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert bag(df.columns, got) == bag(want.columns, want.fetchall())
    assert got
