"""Questions asked of the clean and aggregated tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.money import exact_sum
from strata.operators.silver import completed


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_rows(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, and how many rows have a value: one aggregation."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("filled"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def status_distribution(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "status")


def category_revenue(orders: DataFrame) -> DataFrame:
    """Completed orders per category, by revenue. The mean is not rounded."""
    amount = F.col("total_amount")
    revenue = exact_sum(amount)
    return (
        completed(orders)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            revenue.alias("revenue"),
            F.try_divide(revenue, F.count(amount)).alias("avg_value"),
        )
        .orderBy(F.desc_nulls_last("revenue"), "category")
    )


def latest_days(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.orderBy(F.desc_nulls_last("date")).limit(n)


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    keys = ("product_id", "product_name", "category")
    return products.orderBy(F.desc_nulls_last("total_revenue"), *keys).limit(n)


def top_users(users: DataFrame, n: int = 10) -> DataFrame:
    return users.orderBy(F.desc_nulls_last("total_spend"), "user_id").limit(n)


def funnel_by_visits(pages: DataFrame) -> DataFrame:
    return pages.orderBy(F.desc("visits"), "page")


def revenue_series(daily: DataFrame) -> DataFrame:
    """Revenue and order count by day, for a chart. One row per day, so it is small."""
    return daily.select("date", "revenue", "order_count").orderBy("date")


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n rows by key; a plain limit would return any n rows."""
    return df.orderBy(*keys).limit(n)
