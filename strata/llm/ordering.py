"""A global order without a task that sees all rows: range partitions, sorted each on its own."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.shared import store


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(rows: DataFrame, keys: list[Column], n: int) -> DataFrame:
    """Rows in `n` range partitions whose numbers follow the order of `keys`, sorted within.

    The keys must tell rows apart, so that no value is too frequent for one partition. `rows` should be stored: ranges come from a sample
    of it.
    """
    return rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def bases(sizes: DataFrame) -> DataFrame:
    """`part`, `base`: the sum of `size` of all parts before; one row for each part."""
    rows = sizes.groupBy("part").agg(F.sum("size").cast("bigint").alias("size")).orderBy("part").collect()
    out, total = [], 0
    for row in rows:
        out.append((row["part"], total))
        total += row["size"]
    return sizes.sparkSession.createDataFrame(out, "part int, base bigint")


def numbered(rows: DataFrame, keys: list[Column], name: str, purpose: str) -> DataFrame:
    """The rows with their place in the order of `keys`, from 1, as `name`."""
    ordered = in_order(rows, keys, parts(rows.sparkSession))
    # Numbers within a task: the lower 33 bits of the id, the upper ones are the task's.
    placed = ordered.withColumn("o_id", F.monotonically_increasing_id())
    placed = store(placed.select("*", F.shiftright("o_id", 33).cast("int").alias("part"), F.col("o_id").bitwiseAND((1 << 33) - 1).alias("o_place")), purpose)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    joined = placed.join(F.broadcast(bases(sizes)), "part")
    return joined.withColumn(name, F.col("base") + F.col("o_place") + 1).drop("part", "base", "o_id", "o_place")
