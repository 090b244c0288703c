"""Raw rows to typed, valid, unique rows."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalars import cents, parse_instant
from strata.schemas import (
    CLICK_PAYLOAD, COMPLETED, DEFAULT_REFERRER, ORDER_PAYLOAD, ORDER_STATUSES, POSITION,
)


def parse_payload(bronze: DataFrame, schema: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Payload columns (or those in `fields`), ingestion time and place of each raw row.

    Unreadable text gives NULL columns; a field of the wrong type is NULL on its own. The parser skips
    fields that are not asked for.
    The struct is spread by a generator: filters on its fields would otherwise be moved below
    the projection and parse the text again for each field they use.
    """
    if fields is not None:
        schema = ", ".join(f.strip() for f in schema.split(",") if f.split()[0] in fields)
    payload = F.inline(F.array(F.from_json("raw_value", schema)))
    return bronze.select(payload, "ingested_at", *POSITION)


def first_copy(df: DataFrame, keys: Sequence[str], order: Sequence[str] = POSITION) -> DataFrame:
    """One row per key: the first by `order`, whatever the order of the input.

    The rank is cut to 1 inside each input task before the shuffle (WindowGroupLimit), so a key
    with very many copies sends one row per task, not all its copies to one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def has_id(key: str) -> Column:
    return F.col(key).isNotNull()


def positive(measure: str) -> Column:
    return F.col(measure) > 0


def known_status() -> Column:
    return F.col("status").isin(*ORDER_STATUSES)


def visit_referrer() -> Column:
    """A missing referrer is a direct visit."""
    return F.coalesce("referrer", F.lit(DEFAULT_REFERRER))


def order_rules() -> dict[str, Column]:
    """What an order must meet, in the order the rules are tried."""
    return {"no_id": has_id("order_id"), "not_positive": positive("total_amount"), "unknown_status": known_status()}


def click_rules() -> dict[str, Column]:
    return {"no_id": has_id("click_id"), "not_positive": positive("duration_ms")}


def meets(rules: dict[str, Column]) -> Column:
    return reduce(and_, rules.values())


def valid_orders(events: DataFrame) -> DataFrame:
    """Orders with an id, a positive amount and a known status."""
    return events.where(meets(order_rules()))


def valid_clicks(events: DataFrame) -> DataFrame:
    """Clicks with an id and a positive duration."""
    return events.where(meets(click_rules()))


def typed_orders(events: DataFrame) -> DataFrame:
    return events.withColumns({"event_ts": parse_instant(F.col("timestamp")), "total_amount": cents(F.col("total_amount"))})


def typed_clicks(events: DataFrame) -> DataFrame:
    return events.withColumns({"event_ts": parse_instant(F.col("timestamp")), "referrer": visit_referrer()})


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == COMPLETED)


def silver_orders(
    bronze: DataFrame, clock: Column | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """Clean orders. Rows are validated first, so a bad copy never displaces a good one.

    With `fields` only these payload fields are parsed, and those the rules need.
    """
    wanted = None if fields is None else {*fields, "order_id", "total_amount", "status", "timestamp"}
    return unique(typed_orders(valid_orders(parse_payload(bronze, ORDER_PAYLOAD, wanted))), "order_id", clock)


def silver_clicks(
    bronze: DataFrame, clock: Column | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """Clean clicks. With `fields` only these payload fields are parsed, and those the rules need."""
    wanted = None if fields is None else {*fields, "click_id", "duration_ms", "timestamp", "referrer"}
    return unique(typed_clicks(valid_clicks(parse_payload(bronze, CLICK_PAYLOAD, wanted))), "click_id", clock)


def unique(events: DataFrame, key: str, clock: Column | None = None) -> DataFrame:
    """The first copy of each id, without its place, stamped with the time of cleaning."""
    stamp = F.current_timestamp() if clock is None else clock
    return first_copy(events, [key]).drop(*POSITION).withColumn("processed_at", stamp)
