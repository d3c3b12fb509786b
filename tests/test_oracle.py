"""Every query with checking SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["dataset", "model", "tuning", "scoring", "n", "rho"]
