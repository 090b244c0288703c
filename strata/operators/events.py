"""Events as topic records, and topic records as raw (bronze) rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import CLICK_PAYLOAD, ORDER_PAYLOAD


def payload_fields(schema: str) -> list[str]:
    """Field names of a payload, in order."""
    return [field.split()[0] for field in schema.replace("\n", " ").split(",")]


def to_payload(fields: Sequence[str]) -> Column:
    """JSON text of the given columns; NULL fields are written as null."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame, key: str, topic: str, schema: str) -> DataFrame:
    """Add binary key and value and the topic to typed events; the payload columns go."""
    fields = payload_fields(schema)
    rest = [c for c in events.columns if c not in fields]
    return events.select(
        F.col(key).cast("binary").alias("key"),
        to_payload(fields).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        *rest,
    )


def route_events(events: DataFrame) -> DataFrame:
    """Topic, key and value of a mixed set of orders and clicks (union of both column sets)."""
    is_order = F.col("event_type") == "order"
    value = F.when(is_order, to_payload(payload_fields(ORDER_PAYLOAD))).otherwise(
        to_payload(payload_fields(CLICK_PAYLOAD))
    )
    return events.select(
        F.when(is_order, F.lit("orders")).otherwise(F.lit("clicks")).alias("topic"),
        F.coalesce("order_id", "click_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
    )


def to_bronze(records: DataFrame, clock: Column | None = None) -> DataFrame:
    """Topic records to raw rows: text key and value, their place, and the ingestion time."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if clock is None else clock).alias("ingested_at"),
    )
