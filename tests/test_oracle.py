"""Every registered query equals its SQL twin."""

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect

from vitrine.plans.oracles import oracle_queries
from vitrine.plans.queries import QUERIES

ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, small, name):
    assert compare(spark, con, small, name, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).limit(3).count() == 3
