"""Every registered query on the smallest tables, against DuckDB where SQL can state it."""

import re

import __spark_entry__ as registry
import compare
import pytest

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()
# These have tests of their own in tests/llm.
LLM = re.compile(r"op\d+_|pipeline$")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if not LLM.match(n)))
def test_same_rows_as_duckdb(spark, duck, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = compare.duck_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(ORACLES) if not LLM.match(n)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
