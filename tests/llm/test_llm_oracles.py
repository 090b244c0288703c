"""The registered queries that SQL can state, against DuckDB."""

import compare
import pytest
from strata.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_duckdb(spark, name):
    columns, rows = compare.spark_rows(queries.queries()[name](spark, SF_DIR))
    expected_columns, expected = compare.duck_rows(compare.connect(SF_DIR), queries.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
