from datetime import datetime

from helpers import plan_of, silver_orders
from strata.operators import events, explore
from strata.schemas import CLICK_PAYLOAD, ORDER_PAYLOAD

D1 = datetime(2024, 1, 1)


def test_status_distribution_and_categories(spark):
    orders = silver_orders(spark, [
        ("a", "u1", "p1", 3.0, "completed", D1), ("b", "u1", "p1", 4.5, "completed", D1),
        ("c", "u1", "p1", 4.0, "pending", D1),
    ])
    assert [tuple(r) for r in explore.status_distribution(orders).collect()] == [("completed", 2), ("pending", 1)]
    assert [tuple(r) for r in explore.category_revenue(orders).collect()] == [("Home", 2, 7.5, 3.75)]


def test_top_users_puts_null_last_and_breaks_ties_by_id(spark):
    rows = [("b", 5.0), ("a", 5.0), ("n", None), ("c", 9.0)]
    users = spark.createDataFrame(rows, "user_id string, total_spend double")
    assert [r.user_id for r in explore.top_users(users).collect()] == ["c", "a", "b", "n"]
    assert "TakeOrderedAndProject" in plan_of(explore.top_users(users))


def test_latest_days(spark):
    days = spark.createDataFrame([(datetime(2024, 1, d), 1.0, d) for d in range(1, 15)] + [(None, 1.0, 0)],
                                 "date timestamp, revenue double, order_count int")
    assert [r.order_count for r in explore.latest_days(days).collect()] == list(range(14, 4, -1))
    assert [r.order_count for r in explore.revenue_series(days).collect()] == list(range(15))


def test_first_rows_and_count(spark):
    df = spark.range(100)
    assert [r.id for r in explore.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert explore.row_count(df).first().row_count == 100


def test_schema_rows(spark):
    got = explore.schema_rows(spark.range(1)).collect()
    assert [tuple(r) for r in got] == [(0, "id", "bigint", False, 1)]


def test_encode_keeps_null_fields_and_null_keys(spark):
    fields = events.payload_fields(CLICK_PAYLOAD)
    assert len(fields) == 13 and len(events.payload_fields(ORDER_PAYLOAD)) == 16
    row = spark.createDataFrame(
        [("click", None, "u", "s", "p", "n", "c", "home", None, "mobile", 5, True, "t")], CLICK_PAYLOAD
    )
    got = events.encode_events(row, "click_id", "clicks", CLICK_PAYLOAD).first()
    assert got.key is None and got.topic == "clicks"
    text = bytes(got.value).decode()
    assert '"referrer":null' in text and '"click_id":null' in text


def test_route(spark):
    from pyspark.sql import functions as F

    names = set(events.payload_fields(ORDER_PAYLOAD)) | set(events.payload_fields(CLICK_PAYLOAD))
    base = spark.createDataFrame([("order", "o1", None), ("click", None, "c1")],
                                 "event_type string, order_id string, click_id string")
    mixed = base.withColumns({n: F.lit(None).cast("string") for n in names - set(base.columns)})
    got = [(r.topic, bytes(r.key).decode()) for r in events.route_events(mixed).collect()]
    assert got == [("orders", "o1"), ("clicks", "c1")]
