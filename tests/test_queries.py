"""Every registered query against its SQL."""

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as contract
import oracle_queries
import registered_queries


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_contract():
    assert set(oracle_queries.SQL) == set(registered_queries.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(contract.queries()) >= set(registered_queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle_queries.SQL))
def test_matches_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, SMALL), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 15 and "health_score" in result.columns
