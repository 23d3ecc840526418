"""Queries that SQL can express against their statements, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from verification.compare import connect, differences
from waybill.llm import queries, sql

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the generated tables")


def test_all_operators_are_registered():
    numbers = {int(key[2:].split("_")[0]) for key in queries.QUERIES if key.startswith("op")}
    assert numbers == set(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= contract.queries().keys()
    assert sql.STATEMENTS.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("key", sql.STATEMENTS)
def test_query_agrees_with_sql(spark, key):
    con = connect(SF_DIR)
    assert differences(con, queries.QUERIES[key](spark, SF_DIR), sql.STATEMENTS[key])[1] == ""
