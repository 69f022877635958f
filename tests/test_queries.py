"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from snapledger.queries import ORACLE, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, con, name):
    ok, note, _ = compare(spark, con, name, contract.queries()[name], contract.oracle_sql().get(name), SF)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE)
