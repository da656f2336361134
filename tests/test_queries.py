"""Every registered query against its reference SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from chronolake.checks import oracles, registry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_reference_sql():
    assert set(registry.registered()) == set(oracles.sql())
    assert set(registry.registered()) <= set(contract.queries())
    assert set(oracles.sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registry.registered()))
def test_query_matches_reference_sql(spark, connection, name):
    assert compare(contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name], connection) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
