"""Registered queries that SQL can express, against DuckDB."""

import pytest
from compare import rows_of_spark, rows_of_sql
from llm_fixtures import SF, connect

import __spark_entry__ as registry
from claimloom.llm.oracle import ORACLE
from claimloom.llm.queries import QUERIES


def test_all_are_registered():
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in QUERIES}


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    names, expected = rows_of_sql(connect(), ORACLE[name])
    assert sorted(df.columns) == names
    assert rows_of_spark(df) == expected
