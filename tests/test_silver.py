import random
from datetime import datetime

from helpers import bronze, click, order
from pyspark.sql import functions as F
from strata.functions.scalars import parse_instant
from strata.operators import silver
from strata.schemas import CLICK_PAYLOAD, ORDER_PAYLOAD


def test_json_cases(spark):
    texts = [
        '{"order_id":"a","quantity":2,"total_amount":3.5}',
        '{"order_id":"b","quantity":"x","total_amount":3.5}',
        '{"order_id":"c","quantity":2.5,"total_amount":"3.5"}',
        '{"order_id":7,"quantity":3,"extra":{"z":1}}',
        "not json", '[{"order_id":"arr"}]', '{"ORDER_ID":"case"}', "", None,
    ]
    got = silver.parse_payload(bronze(spark, texts), ORDER_PAYLOAD).orderBy("offset")
    assert [(r.order_id, r.quantity, r.total_amount) for r in got.collect()] == [
        ("a", 2, 3.5), ("b", None, 3.5), ("c", None, None), ("7", 3, None),
    ] + [(None, None, None)] * 5


def test_wrong_boolean_is_null(spark):
    parsed = silver.parse_payload(bronze(spark, [click(converted="true")]), CLICK_PAYLOAD)
    assert parsed.first().converted is None


def test_instants(spark):
    texts = [
        "2024-01-01T10:11:12.123456+00:00", "2024-01-01T10:11:12+00:00",
        "2024-01-01T10:11:12.5Z", "garbage", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(parse_instant(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [
        datetime(2024, 1, 1, 10, 11, 12, 123456), datetime(2024, 1, 1, 10, 11, 12),
        datetime(2024, 1, 1, 10, 11, 12, 500000), None, None,
    ]


def test_orders_rejected(spark):
    payloads = [
        order("ok"), order(None), order("zero", total_amount=0), order("neg", total_amount=-1),
        order("none", total_amount=None), order("s1", status=None), order("s2", status="unknown"),
        order("s3", status="COMPLETED"), "{",
    ]
    assert [r.order_id for r in silver.silver_orders(bronze(spark, payloads)).collect()] == ["ok"]


def test_amount_rounding_and_bad_time(spark):
    payloads = [
        order("a", total_amount=2.675), order("b", total_amount=1.005),
        order("c", total_amount=5.0, timestamp="bad"),
    ]
    got = {r.order_id: r for r in silver.silver_orders(bronze(spark, payloads)).collect()}
    assert (got["a"].total_amount, got["b"].total_amount) == (2.68, 1.01)
    assert got["c"].event_ts is None


def test_clicks_rejected_and_referrer(spark):
    payloads = [
        click("ok", referrer=None), click(None), click("zero", duration_ms=0),
        click("neg", duration_ms=-1), click("none", duration_ms=None),
    ]
    got = silver.silver_clicks(bronze(spark, payloads, "clicks")).collect()
    assert [(r.click_id, r.referrer) for r in got] == [("ok", "direct")]


def test_columns(spark):
    got = silver.silver_orders(bronze(spark, [order()]), F.lit("2025-01-01").cast("timestamp"))
    fields = [f.split()[0] for f in ORDER_PAYLOAD.split(",")]
    assert got.columns == fields + ["ingested_at", "event_ts", "processed_at"]


def test_invalid_copy_never_displaces_a_valid_one(spark):
    payloads = [order("a", total_amount=0), order("a", total_amount=7.0), order("a", total_amount=9.0)]
    got = silver.silver_orders(bronze(spark, payloads)).collect()
    assert [r.total_amount for r in got] == [7.0]


def test_survivor_ignores_input_order_and_partitioning(spark):
    payloads = [order(f"o{i % 50}", total_amount=1.0 + i) for i in range(400)]
    rows = bronze(spark, payloads)
    expected = {f"o{i}": 1.0 + i for i in range(50)}
    for parts in (1, 3, 16):
        shuffled = rows.orderBy(F.rand(parts)).repartition(parts)
        got = silver.silver_orders(shuffled)
        assert {r.order_id: r.total_amount for r in got.collect()} == expected


def test_twice_the_input_is_the_same_result(spark):
    rows = bronze(spark, [order(f"o{i}") for i in range(20)])
    once, twice = (silver.silver_orders(df).drop("processed_at") for df in (rows, rows.union(rows)))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_hot_key_sends_one_row_per_task(spark):
    """A third of all rows are copies of one id; they are cut to one row per task before the shuffle."""
    rng = random.Random(1)
    payloads = [order("hot" if i % 3 == 0 else f"o{rng.randrange(300)}", total_amount=1.0 + i) for i in range(3000)]
    df = silver.silver_orders(bronze(spark, payloads).repartition(8))
    expected = {}
    for i, p in enumerate(payloads):
        expected.setdefault(p["order_id"], 1.0 + i)
    assert {r.order_id: r.total_amount for r in df.collect()} == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_text_is_parsed_once(spark, tmp_path):
    bronze(spark, [order()]).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    plan = silver.silver_orders(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
