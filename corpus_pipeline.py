"""From raw documents to a training mix: quality rules, line dedup, near-duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet in the shared folder and read again
as the next one's documents. All but the last return the columns of documents; the last adds the size, the
targets, the words that the mix takes of each document and the number of output shards that hold some.

Cases: null and wordless texts have too few words and go with the quality rules; long texts are read whole; rows that repeat are alike in
every stage, and of equal ones the near-duplicate stage keeps one; other columns pass through, also under names that the stages use
themselves (a new column of the last stage is then called mix_ and its name); empty tables give an empty result.
"""

from pyspark.sql import DataFrame, SparkSession

from strata.llm.decontamination import decontamination_stage
from strata.llm.line_dedup import line_dedup_stage
from strata.llm.mixing import mixing_stage
from strata.llm.quality_rules import quality_stage
from strata.llm.shared import store, table
from strata.llm.simhash import simhash_stage

STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The robust estimates, edit distances and keyed draws of the stages have no SQL form; a test compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
