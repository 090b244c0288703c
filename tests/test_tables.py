import pytest
from pyspark.errors import AnalysisException
from strata.sources import tables
from strata.sources.scratch import scratch_root


def numbers(spark, *values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def values(df):
    return sorted(r[0] for r in df.collect())


def test_missing_table(spark, root):
    assert tables.try_read_table(spark, root, "silver", "orders") is None
    assert tables.try_read_table(spark, root, "bronze", "orders") is None
    assert tables.latest(spark, root, "silver", "orders") is None
    with pytest.raises(AnalysisException):
        tables.read_table(spark, root, "silver", "orders")


def test_other_errors_are_not_hidden(spark, root):
    tables.write_snapshot(numbers(spark, 1), root, "gold", "t")
    with pytest.raises(ValueError, match="no version 7"):
        tables.try_read_table(spark, root, "gold", "t", 7)


def test_snapshots_replace_rows_and_schema(spark, root):
    first = tables.write_snapshot(numbers(spark, 1, 2, 3), root, "gold", "t")
    second = tables.write_snapshot(numbers(spark, 9, name="y"), root, "gold", "t")
    assert [(c.version, c.rows) for c in (first, second)] == [(0, 3), (1, 1)]
    assert values(tables.read_table(spark, root, "gold", "t", 0)) == [1, 2, 3]
    latest = tables.read_table(spark, root, "gold", "t")
    assert latest.columns == ["y"] and values(latest) == [9]


def test_appends_add_up_from_the_last_snapshot(spark, root):
    assert tables.append_rows(numbers(spark, 1), root, "silver", "t").rows == 1
    assert tables.append_rows(numbers(spark, 2, 3), root, "silver", "t").rows == 2
    assert values(tables.read_table(spark, root, "silver", "t")) == [1, 2, 3]
    tables.write_snapshot(numbers(spark, 7), root, "silver", "t")
    tables.append_rows(numbers(spark, 8), root, "silver", "t")
    assert values(tables.read_table(spark, root, "silver", "t")) == [7, 8]


def test_unfinished_refresh_is_invisible_and_written_again(spark, root):
    import os

    tables.write_snapshot(numbers(spark, 1), root, "silver", "t")
    unfinished = tables.refresh_path(root, "silver", "t", 1)
    numbers(spark, 666).write.parquet(unfinished)
    os.remove(f"{unfinished}/_SUCCESS")
    assert values(tables.read_table(spark, root, "silver", "t")) == [1]
    tables.write_snapshot(numbers(spark, 3), root, "silver", "t")
    assert values(tables.read_table(spark, root, "silver", "t")) == [3]


def test_a_table_can_be_rewritten_from_itself(spark, root):
    tables.write_snapshot(numbers(spark, 1, 2), root, "silver", "t")
    own = tables.read_table(spark, root, "silver", "t")
    tables.write_snapshot(own.where("x > 1"), root, "silver", "t")
    assert values(tables.read_table(spark, root, "silver", "t")) == [2]


def test_history_newest_first(spark, root):
    for v in range(12):
        tables.write_snapshot(numbers(spark, *range(v)), root, "gold", "t")
    rows = tables.history(spark, root, "gold", "t").collect()
    assert [(r.version, r.row_count) for r in rows] == [(v, v) for v in range(11, 1, -1)]
    assert rows[0].timestamp >= rows[-1].timestamp


def test_names(spark, root):
    tables.write_snapshot(numbers(spark, 1, 2), root, "gold", "funnel")
    tables.write_snapshot(numbers(spark, 7, name="y"), root, "gold", "funnel")
    tables.append_rows(numbers(spark, 8, name="y"), root, "gold", "funnel")
    assert tables.register_layers(spark, root) == ["gold.funnel"]
    tables.register_table(spark, root, "gold", "funnel", 0)
    assert spark.sql("SELECT sum(y) FROM gold.funnel").first()[0] == 15
    assert spark.sql("SELECT sum(x) FROM gold.funnel_v0").first()[0] == 3


def test_intermediate_tables_need_a_folder(spark):
    with pytest.raises(ValueError, match="shared folder"):
        scratch_root("", "x")
