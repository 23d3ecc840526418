"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from verification import registry
from verification.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert registry.QUERIES.keys() <= contract.queries().keys()
    assert registry.QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("key", registry.QUERIES)
def test_query_agrees_with_sql(spark, con, key):
    _, problem = differences(con, contract.queries()[key](spark, SF_DIR), contract.oracle_sql()[key])
    assert problem == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
