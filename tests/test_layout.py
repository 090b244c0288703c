import os
from datetime import date, datetime, timedelta

from helpers import order, plan_of, records, silver_orders
from pyspark.sql import functions as F
from strata.operators import gold
from strata.plans import dated
from strata.sources import layout, tables
from strata.streaming import ingest

DAYS = [datetime(2024, 1, 1, 5) + timedelta(days=i) for i in range(6)]


def some(spark, first, days, status="completed"):
    return silver_orders(spark, [(f"o{first + i}", f"u{i % 3}", "p1", 1.0 + i, status, d) for i, d in enumerate(days)])


def rows(df):
    return sorted(map(repr, df.drop("updated_at").collect()))


def files(root, layer, name):
    top = tables.refresh_path(root, layer, name, 0)
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def files_read(df):
    """How many files the scan of a plan without exchanges has opened."""
    df.collect()
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return scans.head().metrics().apply("numFiles").value()


def test_dates_prune_files(spark, root):
    orders = some(spark, 0, [*DAYS, None])
    assert dated.write_dated_orders(orders, root).rows == 7
    revenue = dated.revenue_between(spark, root, "2024-01-02", "2024-01-03")
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(revenue)
    assert files_read(layout.between(tables.read_table(spark, root, "silver", "orders_dated"), "2024-01-02", "2024-01-03")) == 2
    expected = gold.daily_revenue(orders).where("date between '2024-01-02' and '2024-01-03'")
    assert rows(revenue) == rows(expected)
    assert rows(dated.revenue_between(spark, root)) == rows(gold.daily_revenue(orders))


def test_latest_dates(spark, root):
    orders = some(spark, 0, DAYS[:4]).unionByName(some(spark, 10, DAYS[4:], "pending"))
    dated.write_dated_orders(orders, root)
    got = dated.latest_revenue(spark, root, 2)
    assert [r.date.date() for r in got.collect()] == [date(2024, 1, 4), date(2024, 1, 3)]
    assert files_read(layout.latest_dates(spark, root, "silver", "orders_dated", 2)) == 2
    assert dated.latest_revenue(spark, root, 50).count() == 4


def test_late_events_rewrite_their_dates_only(spark, root):
    first = some(spark, 0, [*DAYS, None])
    dated.write_dated_orders(first, root)
    dated.refresh_dates(spark, root, first)
    before = {x: files(root, *x) for x in (("silver", "orders_dated"), ("gold", "daily_revenue_dated"))}
    late = some(spark, 100, [DAYS[1], DAYS[1], None, datetime(2023, 12, 31)])
    dated.add_late_orders(late, root)
    done = dated.refresh_dates(spark, root, late)
    assert done.rows == 3
    touched = ("2024-01-02", "__HIVE_DEFAULT_PARTITION__", "2023-12-31")
    for x, old in before.items():
        new = files(root, *x)
        kept = {f: t for f, t in old.items() if not any(d in f for d in touched)}
        assert kept and kept.items() <= new.items()
        assert all(any(d in f for d in touched) for f in set(new) - set(kept))
    everything = first.unionByName(late)
    stored = tables.read_table(spark, root, "silver", "orders_dated")
    assert rows(stored.select(*first.columns)) == rows(everything)
    assert rows(tables.read_table(spark, root, "gold", "daily_revenue_dated").drop("event_date")) == rows(gold.daily_revenue(everything))


def test_folders_of_months(spark, root):
    orders = some(spark, 0, [*DAYS, datetime(2024, 2, 3), None])
    dated.write_dated_orders(orders, root, "month")
    assert layout.date_folders(spark, root, "silver", "orders_dated") == ["2024-01-01", "2024-02-01"]
    stored = tables.read_table(spark, root, "silver", "orders_dated")
    assert files_read(layout.between(stored, "2024-01-03", "2024-01-31", unit="month")) == 1
    got = dated.revenue_between(spark, root, "2024-01-03", "2024-02-02", "month")
    assert rows(got) == rows(gold.daily_revenue(orders).where("date between '2024-01-03' and '2024-02-02'"))
    late = some(spark, 50, [DAYS[0]])
    dated.add_late_orders(late, root, "month")
    dated.refresh_dates(spark, root, orders.unionByName(late), "month")
    got = tables.read_table(spark, root, "gold", "daily_revenue_dated").drop("event_date")
    assert rows(got) == rows(gold.daily_revenue(orders.unionByName(late)))


def test_a_date_has_few_files(spark, root):
    many = spark.range(20_000, numPartitions=16).select(
        F.format_string("o%d", "id").alias("order_id"), F.lit("u").alias("user_id"), F.lit("completed").alias("status"), F.lit(1.0).alias("total_amount"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 5) * 86400).alias("event_ts"),
    )
    layout.write_dated(many, root, "silver", "t")
    assert len(files(root, "silver", "t")) == 5


def put(spark, root, payloads, first):
    records(spark, payloads, "orders", first).coalesce(1).write.mode("append").parquet(f"{root}/topics/orders")


def stream(spark, root, name="main"):
    source = ingest.read_events(spark, "orders", "parquet", path=f"{root}/topics/orders", maxFilesPerTrigger=1)
    ingest.write_bronze(source, root, "orders", ingest.ALL_AVAILABLE, name).awaitTermination()


def test_compaction_bounds_the_files(spark, root):
    for i in range(13):
        put(spark, root, [order(f"o{i}")], i)
    stream(spark, root)
    plain = rows(tables.read_table(spark, root, "bronze", "orders"))
    assert len(tables.read_table(spark, root, "bronze", "orders").inputFiles()) >= 13
    assert rows(layout.read_compacted(spark, root, "orders")) == plain
    assert layout.compact_bronze(spark, root, "orders") == {"main": 12}
    packed = layout.read_compacted(spark, root, "orders")
    assert len(packed.inputFiles()) == 1 and rows(packed) == plain
    for i in (13, 14):
        put(spark, root, [order(f"o{i}")], i)
    stream(spark, root)
    packed = layout.read_compacted(spark, root, "orders")
    assert len(packed.inputFiles()) == 3 and packed.count() == 15
    stream(spark, root, "second")
    assert layout.read_compacted(spark, root, "orders").count() == 30
    assert layout.compact_bronze(spark, root, "orders") == {"main": 14, "second": 14}
    assert layout.compact_bronze(spark, root, "orders") == {"main": 14, "second": 14}
    packed = layout.read_compacted(spark, root, "orders")
    assert len(packed.inputFiles()) == 2
    assert rows(packed) == rows(tables.read_table(spark, root, "bronze", "orders"))


def test_compaction_that_died_counts_for_nothing(spark, root):
    for i in range(3):
        put(spark, root, [order(f"o{i}")], i)
    stream(spark, root)
    path = layout.packed_path(root, "orders", "main", 2)
    records(spark, [order("x")]).write.parquet(path)
    os.remove(f"{path}/_SUCCESS")
    assert layout.read_compacted(spark, root, "orders").count() == 3
    layout.compact_bronze(spark, root, "orders")
    assert layout.read_compacted(spark, root, "orders").count() == 3
