"""How often the registered queries work out what several of their steps read."""

import __spark_entry__ as registry
import pytest
from pyspark.sql import functions as F
from strata.plans import dated
from strata.plans.propensity import propensity
from strata.sources import tables
from test_layout import DAYS, rows, some

SMALL = "/root/testdata/sf0.001"


def counting(spark, df, column):
    """The same rows, and how many of them were worked out, whatever else their plan reads."""
    worked = spark.sparkContext.accumulator(0)

    def seen(x):
        worked.add(1)
        return x

    return df.withColumn(column, F.udf(seen, df.schema[column].dataType).asNondeterministic()(column)), worked


@pytest.fixture
def bronze(spark, monkeypatch):
    """Bronze orders that count themselves; and how many there are."""
    plain = registry.bronze_orders(spark, SMALL)
    counted, worked = counting(spark, plain, "raw_value")
    monkeypatch.setattr(registry, "bronze_orders", lambda s, d: counted)
    return worked, plain.count()


def test_late_orders_are_worked_out_once(spark, root):
    first = some(spark, 0, DAYS)
    dated.write_dated_orders(first, root)
    late, worked = counting(spark, some(spark, 100, DAYS[:2]), "event_ts")
    assert dated.add_late_orders(late, root).rows == 4
    assert worked.value == 2
    assert rows(tables.read_table(spark, root, "silver", "orders_dated").drop("event_date", "processed_at")) == rows(
        first.unionByName(some(spark, 100, DAYS[:2])).drop("processed_at")
    )
    assert not list(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/silver").where("path like '%/_late/%'").collect())


# A half of the orders is cleaned from all rows here, since the counter stands before the filter.
@pytest.mark.parametrize("name, most", [("snapshot_overwrite", 1), ("revenue_by_date", 2), ("latest_days_pruned", 2), ("late_dates", 2)])
def test_orders_are_cleaned_once(spark, bronze, name, most):
    worked, n = bronze
    assert registry.queries()[name](spark, SMALL).count() > 0
    assert worked.value <= most * n


@pytest.mark.parametrize("name", ["tree_scores", "tree_importances"])
def test_tree_queries_store_their_users_once(spark, monkeypatch, name):
    stored, calls = registry.stored_users(spark, SMALL), []
    monkeypatch.setattr(registry, "stored_users", lambda s, d: calls.append(d) or stored)
    monkeypatch.setattr(registry, "propensity", lambda *a: propensity(*a, trees=2, rounds=2, depth=2))
    assert registry.queries()[name](spark, SMALL).count() > 0
    assert len(calls) == 1
