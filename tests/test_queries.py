"""Every registered query against its SQL in another engine."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from starloom.catalog import REGISTRY


@pytest.fixture(scope="module")
def oracle(sf):
    return connect(sf)


def test_contract(spark):
    assert REGISTRY.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).columns[0] == "songplay_id"


@pytest.mark.parametrize("name", list(REGISTRY))
def test_same_rows(spark, sf, oracle, name):
    assert compare(spark, oracle, name, sf) == []
