"""Column contracts of the three layers.

Field names, types and the status list are fixed values of the data model: results
depend on them, so they are stated as they are.
"""

KAFKA_RECORD = """
    key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp
"""

ENVELOPE = """
    kafka_key string, raw_value string, topic string, partition int, offset bigint,
    kafka_timestamp timestamp, ingested_at timestamp
"""

ORDER_PAYLOAD = """
    event_type string, order_id string, user_id string, session_id string,
    product_id string, product_name string, category string, quantity int,
    unit_price double, total_amount double, currency string, status string,
    payment_method string, country string, timestamp string, kafka_key string
"""

CLICK_PAYLOAD = """
    event_type string, click_id string, user_id string, session_id string,
    product_id string, product_name string, category string, page string,
    referrer string, device string, duration_ms int, converted boolean, timestamp string
"""

ORDER_STATUSES = ("completed", "pending", "cancelled", "refunded")
COMPLETED = "completed"
CANCELLED = "cancelled"
DEFAULT_REFERRER = "direct"

# Place of a record in its topic. All copies of one key share the Kafka partition, so this
# orders the copies of an id.
POSITION = ("partition", "offset")

LAYERS = {
    "bronze": ("orders", "clicks"),
    "silver": ("orders", "clicks"),
    "gold": ("daily_revenue", "product_metrics", "user_metrics", "funnel"),
    "ml": (
        "models", "scored_users", "classification_report", "confusion_matrix", "feature_importance",
        "segment_distribution", "score_histogram",
    ),
}

FEATURES = (
    "total_orders", "completed_orders", "cancelled_orders", "avg_order_value",
    "unique_products_bought", "total_clicks", "total_sessions",
)
LABEL = "is_high_value"
SPEND_THRESHOLD = 200.0
