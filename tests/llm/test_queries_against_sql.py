"""Registered queries of the subpackage against their SQL."""

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, oracle_connection
from conftest import TEST_DATA
from stratamart.llm import oracle, queries


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(TEST_DATA)


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(oracle.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(oracle.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, TEST_DATA) == ""
