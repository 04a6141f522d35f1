"""Every registered query against its SQL on the sf0.01 tables."""

import pytest
from compare import TABLES_DIR, connect, spark_rows, sql_rows

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()
# Those of the training-data package, where it is present, have tests of their own.
OTHERS = set() if contract.llm_queries is None else {*contract.llm_queries.queries(), "pipeline"}
NAMES = [name for name in contract.queries() if name not in OTHERS]


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES_DIR)


def test_every_query_has_sql():
    assert set(NAMES) == set(ORACLES) - OTHERS


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, TABLES_DIR)
    expected, names = sql_rows(duck, ORACLES[name])
    assert sorted(result.columns) == names
    assert spark_rows(result) == expected
    assert expected


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
