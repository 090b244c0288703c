"""Helpers of the operators in this package: reading, stored intermediate tables, words."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a folder of our own only where none is set, as in tests."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="strata-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def store_path(spark: SparkSession, purpose: str) -> str:
    """A new folder in the shared folder."""
    return f"{shared_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"


def store(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    Cuts the lineage, fixes what a retried task would compute anew, and gives the planner true sizes.
    """
    path = store_path(df.sparkSession, purpose)
    # zstd frees its buffers with the writer; others leave that to the collection of the heap.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and tab to carriage return."""
    return F.array_remove(F.split(text, GAP), "")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that names of the operators cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
