from collections import defaultdict
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal
import math
import random

import pytest
from helpers import plan_of, silver_clicks, silver_orders
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from strata.functions.money import exact_mean, exact_sum, price_mean
from strata.functions.scalars import padded_id
from strata.operators import gold

D1, D2 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 6)


def test_daily_revenue(spark):
    rows = [
        ("a", "u1", "p1", 10.10, "completed", D1), ("b", "u1", "p2", 0.25, "completed", D1),
        ("c", "u2", "p1", 5.00, "completed", D2), ("d", "u2", "p1", 9.00, "pending", D2),
        ("e", None, "p1", 1.00, "completed", None),
    ]
    got = gold.daily_revenue(silver_orders(spark, rows)).drop("updated_at").orderBy("date").collect()
    assert [tuple(r) for r in got] == [
        (None, 1.0, 1, 0, 1.0),
        (datetime(2024, 1, 1), 10.35, 2, 1, 5.18),
        (datetime(2024, 1, 2), 5.0, 1, 1, 5.0),
    ]


def test_product_name_is_part_of_the_key(spark):
    rows = silver_orders(spark, [
        ("a", "u1", "p1", 3.0, "completed", D1), ("b", "u2", "p1", 4.0, "completed", D1),
    ]).withColumn("product_name", F.when(F.col("order_id") == "a", "x").otherwise("y"))
    got = gold.product_metrics(rows).orderBy("product_name").collect()
    assert [(r.product_name, r.total_orders, r.total_revenue, r.avg_price, r.units_sold) for r in got] == [
        ("x", 1, 3.0, 1.5, 2), ("y", 1, 4.0, 1.5, 2),
    ]


def test_user_metrics(spark):
    orders = silver_orders(spark, [
        ("a", "u1", "p1", 3.0, "completed", D1), ("b", "u1", "p1", 4.0, "completed", D2),
        ("c", "u1", "p2", 5.0, "completed", D1), ("d", "u1", "p3", 5.0, "cancelled", None),
        ("e", "u2", "p1", 5.0, "pending", D1),
    ])
    clicks = silver_clicks(spark, [
        ("c1", "u1", "s1", "home", True), ("c2", "u1", "s1", "home", None),
        ("c3", "u1", "s2", "home", False), ("c4", "u1", "s2", "home", True),
        ("c5", "u9", "s3", "home", True),
    ])
    got = {r.user_id: r for r in gold.user_metrics(orders, clicks).collect()}
    assert set(got) == {"u1", "u2"}
    one, two = got["u1"], got["u2"]
    assert (one.total_orders, one.completed_orders, one.cancelled_orders) == (4, 3, 1)
    assert (one.total_spend, one.avg_order_value, one.unique_products_bought) == (12.0, 4.0, 3)
    assert (one.first_order_ts, one.last_order_ts) == (D1, D2)
    assert (one.total_clicks, one.converted_clicks, one.total_sessions) == (4, 2, 2)
    assert one.conversion_rate == 0.6
    assert (two.total_spend, two.avg_order_value, two.completed_orders) == (None, None, 0)
    assert (two.total_clicks, two.converted_clicks, two.total_sessions, two.conversion_rate) == (None,) * 4


def test_user_metrics_without_clicks_keeps_the_schema(spark):
    orders = silver_orders(spark, [("a", "u1", "p1", 3.0, "completed", D1)])
    with_clicks = gold.user_metrics(orders, silver_clicks(spark, []))
    without = gold.user_metrics(orders, None)
    assert [(f.name, f.dataType) for f in without.schema] == [(f.name, f.dataType) for f in with_clicks.schema]
    assert without.first().total_clicks is None


def test_funnel(spark):
    clicks = silver_clicks(spark, [
        ("c1", "u1", "s1", "home", True), ("c2", "u1", "s1", "home", None),
        ("c3", "u2", "s2", "home", False), ("c4", "u2", "s2", "cart", True),
    ])
    got = {r.page: tuple(r)[1:6] for r in gold.funnel(clicks).collect()}
    assert got == {"home": (3, 2, 2, 1, 0.25), "cart": (1, 1, 1, 1, 0.5)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=30))
def test_money_is_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(3)
    row = df.agg(exact_sum(F.col("x")).alias("s"), exact_mean(F.col("x")).alias("m")).first()
    mean = (Decimal(sum(cents)) / len(cents) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert row.s == sum(cents) / 100
    assert row.m == float(mean)


def test_money_edges(spark):
    """What has no exact form shows in the result as in a plain sum."""
    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first())

    assert of(None) == (None, None)
    assert of(10.0, 1e17) == (1e17 + 10, (1e17 + 10) / 2)
    assert of(1e300, 1.0, None) == (1e300, 5e299)
    assert of(10.0, math.inf) == (math.inf, math.inf)
    assert all(math.isnan(x) for x in of(10.0, math.nan))
    assert all(math.isnan(x) for x in of(math.inf, -math.inf))
    # Cents beyond 64 bits: as doubles.
    total, mean = of(*[8.9e13] * 1100)
    assert total == pytest.approx(8.9e13 * 1100) and mean == pytest.approx(8.9e13)


def test_amounts_and_counts_agree(spark):
    rows = [(f"o{i}", "u", "p", x, "completed", datetime(2024, 1, 1)) for i, x in enumerate((10.0, math.nan, 1e17, math.inf))]
    daily = gold.daily_revenue(silver_orders(spark, rows)).first()
    assert daily.order_count == 4 and math.isnan(daily.revenue) and math.isnan(daily.avg_order_value)
    big = gold.daily_revenue(silver_orders(spark, [rows[0], rows[2]])).first()
    assert (big.order_count, big.revenue) == (2, 1e17 + 10)


def test_price_is_rounded_once(spark):
    mean = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(price_mean(F.col("x"))).first()[0]
    assert mean(1.00495, 1.00495) == 1.0 and mean(1.005, 1.006) == 1.01 and mean(0.0049, 0.0052) == 0.01
    assert mean(None) is None and mean(1e300, 1.0) == 5e299 and math.isnan(mean(1.0, math.nan))
    assert mean(12345.678912345, 12345.678912345) == 12345.68


def test_long_ids_keep_their_digits(spark):
    got = spark.createDataFrame([(7,), (1234567,)], "n bigint").select(padded_id("U", F.col("n"), 5))
    assert [r[0] for r in got.collect()] == ["U00007", "U1234567"]


def test_hot_user_matches_brute_force(spark):
    """One user has a third of the orders."""
    rng = random.Random(3)
    rows = [
        (f"o{i}", "hot" if i % 3 == 0 else f"u{rng.randrange(40)}", f"p{rng.randrange(9)}",
         rng.randrange(1, 10**6) / 100, rng.choice(["completed", "pending"]), D1)
        for i in range(2000)
    ]
    spend, products = defaultdict(int), defaultdict(set)
    for _, u, p, a, s, _ in rows:
        spend[u] += round(a * 100) if s == "completed" else 0
        products[u].add(p)
    got = gold.user_orders(silver_orders(spark, rows).repartition(7)).collect()
    assert {r.user_id: round((r.total_spend or 0) * 100) for r in got} == dict(spend)
    assert {r.user_id: r.unique_products_bought for r in got} == {u: len(p) for u, p in products.items()}


@pytest.mark.parametrize("build", [gold.daily_revenue, gold.product_metrics, gold.user_orders])
def test_aggregation_starts_before_the_shuffle(spark, build):
    plan = plan_of(build(silver_orders(spark, [("a", "u1", "p1", 3.0, "completed", D1)])))
    assert plan.rindex("partial_count") > plan.rindex("Exchange")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_completed_filter_and_columns_reach_the_scan(spark, tmp_path):
    silver_orders(spark, [("a", "u1", "p1", 3.0, "completed", D1)]).write.parquet(str(tmp_path / "o"))
    plan = plan_of(gold.daily_revenue(spark.read.parquet(str(tmp_path / "o"))))
    assert "EqualTo(status,completed)" in plan
    assert "ReadSchema: struct<user_id:string,total_amount:double,status:string,event_ts:timestamp>" in plan


def test_large_join_reuses_the_grouping(spark, tmp_path):
    """Beyond the broadcast size the two grouped sides are merged without another shuffle."""
    silver_orders(spark, [("a", "u1", "p1", 3.0, "completed", D1)]).write.parquet(str(tmp_path / "o"))
    silver_clicks(spark, [("c1", "u1", "s1", "home", True)]).write.parquet(str(tmp_path / "c"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.user_metrics(spark.read.parquet(str(tmp_path / "o")), spark.read.parquet(str(tmp_path / "c")))
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning(user_id") == 4  # Two per side: distinct, then group.


def test_totals_agree(spark):
    """Daily and product revenue add up to the same cents; no order is lost between the tables."""
    rng = random.Random(9)
    rows = [
        (f"o{i}", f"u{rng.randrange(30)}", f"p{rng.randrange(9)}", rng.randrange(1, 10**7) / 100,
         rng.choice(["completed", "pending", "cancelled", "refunded"]),
         rng.choice([D1, D2, None]))
        for i in range(1500)
    ]
    orders = silver_orders(spark, rows).repartition(5)
    cents = lambda df, c: sum(round(r[c] * 100) for r in df.collect())
    by_day, by_product = gold.daily_revenue(orders), gold.product_metrics(orders)
    spent = gold.user_orders(orders).where("total_spend is not null")
    assert cents(by_day, "revenue") == cents(by_product, "total_revenue") == cents(spent, "total_spend")
    assert sum(r.total_orders for r in gold.user_orders(orders).collect()) == 1500
    done = sum(r.order_count for r in by_day.collect())
    assert done == sum(1 for r in rows if r[4] == "completed")
