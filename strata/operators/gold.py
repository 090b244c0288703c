"""Clean rows to business aggregates.

Every measure has a map-side partial form: a key that holds a third of all rows reaches the
final aggregation as one row per task. Exact distinct counts are grouped by (key, value)
first, so their shuffle is spread by both. The names of the measures are fixed values: they are
the columns of the gold tables.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.money import exact_mean, exact_sum, price_mean
from strata.functions.scalars import day, rate
from strata.operators.silver import completed
from strata.schemas import CANCELLED, COMPLETED


def rows() -> Column:
    """Aggregate: number of orders or clicks.

    Silver ids are never NULL, so the rows are counted without reading the id, which is the
    widest and least compressible column.
    """
    return F.count(F.lit(1))


def _stamped(df: DataFrame, clock: Column | None) -> DataFrame:
    return df.withColumn("updated_at", F.current_timestamp() if clock is None else clock)


def daily_revenue(orders: DataFrame, clock: Column | None = None) -> DataFrame:
    """Completed orders per day; orders without a readable time form the NULL day."""
    days = completed(orders).groupBy(day(F.col("event_ts")).alias("date"))
    return _stamped(
        days.agg(
            exact_sum(F.col("total_amount")).alias("revenue"),
            rows().alias("order_count"),
            F.count_distinct("user_id").alias("unique_customers"),
            exact_mean(F.col("total_amount")).alias("avg_order_value"),
        ),
        clock,
    )


def product_metrics(orders: DataFrame, clock: Column | None = None) -> DataFrame:
    """Completed orders per product; a renamed product counts as another one.

    Unit prices are not rounded on the way in; their mean is rounded once.
    """
    products = completed(orders).groupBy("product_id", "product_name", "category")
    return _stamped(
        products.agg(
            rows().alias("total_orders"),
            exact_sum(F.col("total_amount")).alias("total_revenue"),
            price_mean(F.col("unit_price")).alias("avg_price"),
            F.sum("quantity").alias("units_sold"),
            F.count_distinct("user_id").alias("unique_buyers"),
        ),
        clock,
    )


def user_orders(orders: DataFrame) -> DataFrame:
    """Orders of all statuses per user; the money is that of completed orders only."""
    spent = F.when(F.col("status") == COMPLETED, F.col("total_amount"))
    return orders.groupBy("user_id").agg(
        rows().alias("total_orders"),
        F.count(F.when(F.col("status") == COMPLETED, 1)).alias("completed_orders"),
        F.count(F.when(F.col("status") == CANCELLED, 1)).alias("cancelled_orders"),
        exact_sum(spent).alias("total_spend"),
        exact_mean(spent).alias("avg_order_value"),
        F.max("event_ts").alias("last_order_ts"),
        F.min("event_ts").alias("first_order_ts"),
        F.count_distinct("product_id").alias("unique_products_bought"),
    )


def user_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks, converting clicks and distinct sessions per user."""
    return clicks.groupBy("user_id").agg(
        rows().alias("total_clicks"),
        F.count(F.when(F.col("converted"), 1)).alias("converted_clicks"),
        F.count_distinct("session_id").alias("total_sessions"),
    )


def user_metrics(
    orders: DataFrame, clicks: DataFrame | None, clock: Column | None = None
) -> DataFrame:
    """Order measures of each buyer with the click measures, where there are any.

    Both sides are already grouped by user_id, one row per user, so the join cannot be skewed
    and re-uses their partitioning. The broadcast choice is left to the runtime sizes. Without
    a clicks table the click columns are NULL, so the schema does not change.
    """
    buyers = user_orders(orders)
    if clicks is None:
        joined = buyers.withColumns({
            name: F.lit(None).cast("bigint")
            for name in ("total_clicks", "converted_clicks", "total_sessions")
        })
    else:
        joined = buyers.join(user_clicks(clicks), "user_id", "left")
    conversion = rate(F.col("completed_orders"), F.col("total_clicks"))
    return _stamped(joined.withColumn("conversion_rate", conversion), clock)


def funnel(clicks: DataFrame, clock: Column | None = None) -> DataFrame:
    """Visits, sessions, users and conversions per page."""
    pages = clicks.groupBy("page").agg(
        rows().alias("visits"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count(F.when(F.col("converted"), 1)).alias("conversions"),
    )
    conversion = rate(F.col("conversions"), F.col("visits"))
    return _stamped(pages.withColumn("conversion_rate", conversion), clock)
