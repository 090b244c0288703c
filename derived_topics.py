"""The two event topics, derived from the star-schema tables and the events table.

Every rule is row-local or an equi-join, so the topics grow with the tables without a global
sort. The rules contain defects on purpose (missing ids, bad amounts, unknown states,
unreadable times, broken JSON, duplicates), so every rule of the clean layer has something
to reject. FIXTURES.md lists them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import iso_instant, padded_id
from strata.operators.events import encode_events
from strata.schemas import CLICK_PAYLOAD, ORDER_PAYLOAD

BROKEN_JSON = '{"broken'


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrival(*identity: Column) -> Column:
    """Place of a record among its copies: 60 bits of the md5 of its identity.

    Unique and reproducible, and unrelated to the order of the rows in the files.
    """
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in identity]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order events, one per line item, with their place and a `broken` mark."""
    line = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate",
    )
    buyer = (
        load(spark, sf_dir, "customer")
        .join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name")
    )
    head = (
        load(spark, sf_dir, "orders")
        .join(buyer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "n_name")
    )
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    # Neither side of the first join has a bound on its size: it is always a shuffled join,
    # which the runtime splits where an order is hot.
    joined = line.hint("merge").join(head, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    ordered_at = F.col("o_orderdate").cast("timestamp")
    status = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unknown")
        .when(F.col("l_returnflag") == "R", "refunded")
        .when((F.col("l_returnflag") == "A") | (F.col("o_orderstatus") == "F"), "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("cancelled")
    )
    methods = F.array(*map(F.lit, ("card", "cash", "voucher", "invoice")))
    cents_up = F.when(F.col("l_linenumber") % 2 == 0, 0.004).otherwise(0.0)
    return joined.select(
        F.lit("order").alias("event_type"),
        F.when(
            F.col("l_partkey") % 97 != 0, F.format_string("O%d-%d", "l_orderkey", "l_linenumber")
        ).alias("order_id"),
        padded_id("U", F.col("o_custkey"), 5).alias("user_id"),
        F.format_string("S%d", "l_orderkey").alias("session_id"),
        padded_id("P", F.col("l_partkey"), 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        # More than two decimals: a mean that rounds them on the way in would show.
        (F.col("p_retailprice") + 0.00495).alias("unit_price"),
        F.when(F.col("l_suppkey") % 50 == 0, 0.0)
        .otherwise(F.col("l_extendedprice") + cents_up).alias("total_amount"),
        F.lit("USD").alias("currency"),
        status.alias("status"),
        methods[F.col("l_linenumber") % 4].alias("payment_method"),
        F.col("n_name").alias("country"),
        F.when(F.col("l_partkey") % 89 == 0, "bad-ts")
        .otherwise(iso_instant(ordered_at)).alias("timestamp"),
        F.lit(None).cast("string").alias("kafka_key"),
        (F.col("l_orderkey") % 3).cast("int").alias("partition"),
        arrival(
            F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
            F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyy-MM-dd"),
        ).alias("offset"),
        ordered_at.alias("record_ts"),
        (F.col("l_partkey") % 101 == 0).alias("broken"),
    )


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed click events with a replay of every 20th, with their place and a `broken` mark."""
    copies = F.when(F.col("event_id") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    events = load(spark, sf_dir, "events").select(
        "*", F.get_json_object("props", "$.k").cast("int").alias("k"), F.explode(copies).alias("replay")
    )
    pages = {
        "signup": "home", "error": "search", "view": "product", "click": "category",
        "purchase": "checkout",
    }
    page = F.create_map(*[F.lit(x) for pair in pages.items() for x in pair])
    referrers = F.array(*map(F.lit, ("search", "partner", "mailing", "direct", "forum", None)))
    devices = F.array(*map(F.lit, ("laptop", "phone", "kiosk")))
    at = F.col("ts").cast("timestamp")
    return events.select(
        F.lit("click").alias("event_type"),
        F.when(F.col("event_id") % 97 != 0, F.format_string("C%d", "event_id")).alias("click_id"),
        padded_id("U", F.col("user_id"), 5).alias("user_id"),
        F.format_string("S%d-%s", F.col("user_id"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        padded_id("P", F.col("k"), 6).alias("product_id"),
        F.lit("n/a").alias("product_name"),
        F.lit("n/a").alias("category"),
        page[F.col("event_type")].alias("page"),
        referrers[F.col("k") % 6].alias("referrer"),
        devices[F.col("k") % 3].alias("device"),
        (F.floor(F.col("value") * 100) - 50).cast("int").alias("duration_ms"),
        (F.col("event_type") == "purchase").alias("converted"),
        iso_instant(at).alias("timestamp"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        (F.col("event_id") * 2 + F.col("replay")).alias("offset"),
        at.alias("record_ts"),
        (F.col("event_id") % 101 == 0).alias("broken"),
    )


def _records(events: DataFrame, key: str, topic: str, schema: str) -> DataFrame:
    encoded = encode_events(events, key, topic, schema)
    value = F.when(F.col("broken"), F.lit(BROKEN_JSON).cast("binary")).otherwise(F.col("value"))
    return encoded.select(
        "key", value.alias("value"), "topic", "partition", "offset",
        F.col("record_ts").alias("timestamp"),
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders topic, in the layout of the Kafka source."""
    return _records(order_events(spark, sf_dir), "order_id", "orders", ORDER_PAYLOAD)


def click_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clicks topic, in the layout of the Kafka source."""
    return _records(click_events(spark, sf_dir), "click_id", "clicks", CLICK_PAYLOAD)
