"""Connected components of a link table by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import store

MOST_ROUNDS = 60


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node that can be reached) of every node in the links `u`, `v`.

    A round is two joins and aggregations over the links, whose number never grows; a node with many links is
    a large side of a join, which Spark splits. Rounds grow with the logarithm of the components' size. Links are
    stored between rounds in the shared folder.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    current, before = store(ordered, "links"), None
    for _ in range(MOST_ROUNDS):
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        current = store(small_star(large_star(current).distinct()).distinct(), "links")
    raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")
