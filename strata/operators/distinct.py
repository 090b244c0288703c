"""Exact distinct counts as bitmaps over dense ids, which merge.

A dictionary table gives each value a number from 0 on, without gaps; new values get the next numbers, and a number never changes. A
bitmap has a bit for each of 32,768 numbers: a key's distinct values are one bitmap for each such bucket, 4 KB at most. Bitmaps of any
parts of the rows are merged by OR, so they can be stored and extended; the count is the sum of their bits. Several counts over the
same rows take one aggregation: rows are spread by measure before the partial aggregation, and what is shuffled is bitmaps.

It pays where few keys have very many values (pages, days, everything). Where many keys have few values each (products of a user),
a bitmap of 4 KB for each is more than the values: `partials.members` counts those.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources import tables
from strata.sources.files import matching

DICTIONARY = "value string, id bigint"


def _path(root: str, name: str) -> str:
    return f"{tables.table_path(root, 'dictionary', name)}"


def read_dictionary(spark: SparkSession, root: str, name: str) -> DataFrame:
    """value, id. Each extension is a folder of its own that counts once it is finished."""
    done = [mark.rsplit("/", 1)[0] for mark, _ in matching(spark, f"{_path(root, name)}/from=*/_SUCCESS")]
    return spark.read.schema(DICTIONARY).parquet(*sorted(done)) if done else spark.createDataFrame([], DICTIONARY)


def extend_dictionary(values: DataFrame, root: str, name: str) -> int:
    """Numbers the values (the first column of `values`, as text, without NULL) that the dictionary lacks; how many it has now.

    New values are stored first, so that a task that runs again numbers them alike. Numbers within a partition follow on the sizes of the
    partitions before, one row for each.
    """
    spark = values.sparkSession
    known = read_dictionary(spark, root, name)
    size = known.count()
    first = values.columns[0]
    new = values.select(F.col(f"`{first}`").cast("string").alias("value")).where("value is not null").distinct()
    waiting = f"{root.rstrip('/')}/dictionary/_new/{name}"
    new.join(known.select("value"), "value", "left_anti").withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(waiting)
    placed = spark.read.schema("value string, place bigint").parquet(waiting).withColumn("part", F.shiftright("place", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.lit(size) + F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)
    placed.join(F.broadcast(bases), "part").select("value", number.cast("bigint").alias("id")).write.mode("overwrite").parquet(f"{_path(root, name)}/from={size}")
    return read_dictionary(spark, root, name).count()


def with_ids(rows: DataFrame, columns: dict[str, str], root: str) -> DataFrame:
    """`rows` with `<column>_id` for each column, from the dictionary that `columns` names for it; NULL stays NULL."""
    for column, name in columns.items():
        dictionary = read_dictionary(rows.sparkSession, root, name).withColumnRenamed("id", f"{column}_id")
        rows = rows.join(dictionary, rows[column].cast("string") == dictionary["value"], "left").drop("value")
    return rows


def bitmaps(rows: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """keys, measure, bucket, bits: the distinct ids of each measure (a column of ids) by key."""
    each = [F.struct(F.lit(m).alias("measure"), F.col(c).alias("id")) for m, c in measures.items()]
    spread = rows.select(*keys, F.inline(F.array(*each))).where("id is not null")
    by_bucket = spread.groupBy(*keys, "measure", F.bitmap_bucket_number("id").alias("bucket"))
    return by_bucket.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One bitmap for each key, measure and bucket, from any number of parts."""
    return parts.groupBy(*keys, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(parts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """keys and the number of distinct values of each measure, from merged bitmaps; keys without any value are not there."""
    counted: list[Column] = [F.coalesce(F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))), F.lit(0)).cast("bigint").alias(m) for m in measures]
    return parts.groupBy(*keys).agg(*counted)
