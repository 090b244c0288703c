"""Sessions and users by page from stored bitmaps: new clicks are added, old ones are not read again."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import rate
from strata.operators import distinct
from strata.operators.gold import rows
from strata.sources import tables

IDS = {"session_id": "session_id", "user_id": "user_id"}
MEASURES = {"sessions": "session_id_id", "unique_users": "user_id_id"}


def add_clicks(clicks: DataFrame, root: str) -> None:
    """Adds clean clicks, of ids that were not added before, to the stored counts and bitmaps of the pages."""
    spark = clicks.sparkSession
    for column, name in IDS.items():
        distinct.extend_dictionary(clicks.select(column), root, name)
    new = distinct.bitmaps(distinct.with_ids(clicks, IDS, root), ["page"], MEASURES)
    old = tables.try_read_table(spark, root, "gold", "page_bitmaps")
    both = distinct.merged(new if old is None else old.unionByName(new), ["page"])
    counts = clicks.groupBy("page").agg(rows().alias("visits"), F.count(F.when(F.col("converted"), 1)).alias("conversions"))
    before = tables.try_read_table(spark, root, "gold", "page_counts")
    if before is not None:
        counts = before.unionByName(counts).groupBy("page").agg(F.sum("visits").alias("visits"), F.sum("conversions").alias("conversions"))
    tables.write_snapshot(both, root, "gold", "page_bitmaps")
    tables.write_snapshot(counts, root, "gold", "page_counts")


def funnel(spark: SparkSession, root: str, clock: Column | None = None) -> DataFrame:
    """The same rows as the funnel of all clicks together."""
    counts = tables.read_table(spark, root, "gold", "page_counts")
    uniques = distinct.distinct_counts(tables.read_table(spark, root, "gold", "page_bitmaps"), ["page"], list(MEASURES))
    uniques = uniques.withColumnRenamed("page", "_page")
    joined = counts.join(uniques, F.col("page").eqNullSafe(F.col("_page")), "left").fillna(0, list(MEASURES))
    return joined.select(
        "page", "visits", "sessions", "unique_users", "conversions", rate(F.col("conversions"), F.col("visits")).alias("conversion_rate"),
        (F.current_timestamp() if clock is None else clock).alias("updated_at"),
    )
