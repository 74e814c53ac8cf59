"""Every registered query against its DuckDB oracle."""

import pytest
from compare import compare, connect
from conftest import TESTDATA

import __spark_entry__ as contract_entry

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = contract_entry.queries()
ORACLES = contract_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


CUSTOMER = [name for name in QUERIES if name != "pipeline" and not name.startswith("op")]


def test_every_query_has_an_oracle():
    assert set(CUSTOMER) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, con, name):
    columns, expected_columns, rows, expected = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert contract_entry.entry(spark).count() == 22
