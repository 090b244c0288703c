"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is contained in a document if at least THRESHOLD of its distinct five-word shingles are in it. An item of fewer words is one
shingle, all of its words, and is contained where they stand one after the other. Items are partitioned
by size (numbers of shingles up to 1, 2, 4, 8, ...). The sketch of an item is its bottom-k MinHash: the k shingles of least
permuted hash, k one more than the number of shingles that a contained item of that partition may lack. So a
contained item always has a sketch shingle in the document, and documents with fewer shingles than the threshold
asks for are left out: no contained item is missed. Candidates are verified by counting all shared shingles.

At scale: documents are read once. Tasks keep only shingles that are in a bit set of fixed size over the items' shingles, whose
false hits fall out in the joins; what is shuffled is the shared shingles, not the documents. Joins are keyed by shingle and by
(document, shingle); a passage that many documents hold is a large side that Spark splits. Shingles are compared by
two 64-bit hashes.

Cases: null and wordless texts contain nothing and are in nothing; documents are read for runs of fewer than five words only of the lengths
that short items have; repeated items are found each; repeated rows are judged alike; rows of one doc_id and different texts are judged apart; empty
tables give an empty result. A-Z are lower-cased, words end at white space.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strata.llm.shared import store, table, whole_text, words
from strata.llm.shingles import SEED, bit_set, in_set, small_batches, spans

SHINGLE = 5
THRESHOLD = 0.8
SECOND_SEED = 7
FOUND = "id bigint, t_hash bigint, n_shingles bigint, h1 bigint, h2 bigint"


def runs(words: list[bytes], width: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by spaces, and where each run of `width` words begins and ends; none where there are fewer words."""
    return spans(words, width) if len(words) >= width else (b"", [], [])


def hashed_runs(words: list[bytes], width: int, bits: np.ndarray | None) -> tuple[int, np.ndarray]:
    """How many distinct runs, and both hashes of those in the bit set (all without one)."""
    joined, starts, ends = runs(words, width)
    first = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    at = np.arange(len(first)) if bits is None else np.flatnonzero(in_set(first, bits))
    if not len(at):
        return 0, np.empty((0, 2), np.uint64)
    second = np.fromiter((xxh64_intdigest(joined[starts[i] : ends[i]], SECOND_SEED) for i in at.tolist()), np.uint64, len(at))
    return len(np.unique(first)), np.unique(np.stack((first[at], second), axis=1), axis=0)


def item_shingles(text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number and both hashes of an item's distinct shingles."""
    words = text.encode().lower().split()
    n, pairs = hashed_runs(words, min(len(words), SHINGLE), None) if words else (0, np.empty((0, 2), np.uint64))
    return n, pairs[:, 0], pairs[:, 1]


def document_shingles(text: str, bits: np.ndarray, short: list[int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of a document's distinct shingles, 1 at least, and both hashes of those in the bit set, short runs among them."""
    words = text.encode().lower().split()
    n, pairs = hashed_runs(words, SHINGLE, bits)
    every = np.concatenate([pairs, *[hashed_runs(words, width, bits)[1] for width in short]])
    return max(n, 1), every[:, 0], every[:, 1]


def shingled(rows: DataFrame, of_text) -> DataFrame:
    """A row for each shingle that `of_text` gives for the text of `id`, `t_hash`, `text`."""
    small_batches(rows.sparkSession)

    def of(frames):
        for frame in frames:
            out = []
            for id_, t_hash, text in zip(frame["id"], frame["t_hash"], frame["text"]):
                n, first, second = of_text(text)
                if len(first):
                    out.append((id_, t_hash, n, first, second))
            if out:
                sizes = [len(x[3]) for x in out]
                yield pd.DataFrame({
                    "id": pd.Series([None if pd.isna(x[0]) else int(x[0]) for x in out], dtype="Int64").repeat(sizes).reset_index(drop=True),
                    "t_hash": np.repeat([x[1] for x in out], sizes), "n_shingles": np.repeat([x[2] for x in out], sizes),
                    "h1": np.concatenate([x[3] for x in out]).view(np.int64), "h2": np.concatenate([x[4] for x in out]).view(np.int64),
                })

    return rows.mapInPandas(of, FOUND)


def short_widths(benchmark: DataFrame) -> list[int]:
    """The numbers of words, below that of a shingle, that items have: four at most."""
    n = F.size(words(whole_text()))
    return sorted(row[0] for row in benchmark.select(n.alias("n")).where((F.col("n") > 0) & (F.col("n") < SHINGLE)).distinct().collect())


def texts(rows: DataFrame, id_column: str) -> DataFrame:
    return rows.select(F.col(id_column).cast("bigint").alias("id"), F.xxhash64(whole_text()).alias("t_hash"), whole_text().alias("text"))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """The bottom-k MinHash of each item, k by its size partition."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("m")))
    order = Window.partitionBy("item").orderBy(F.xxhash64("h1", "h2"), "h1", "h2")
    ranked = items.withColumn("k", F.floor((1 - threshold) * upper + 1e-9) + 1).withColumn("rank", F.row_number().over(order))
    return ranked.where("rank <= k").select("item", "m", "h1", "h2")


def contained(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, t_hash (of the text), item_id, n_shared, n_item, containment: a row for each contained item."""
    items = shingled(texts(benchmark, "item_id").distinct(), item_shingles)
    items = store(
        items.select(F.struct(F.col("id").alias("id"), F.col("t_hash").alias("t_hash")).alias("item"), F.col("n_shingles").alias("m"), "h1", "h2"),
        "item-shingles",
    )
    bits, short = bit_set(F.col("h1"), items), short_widths(benchmark)
    hits = store(shingled(texts(docs, "doc_id"), lambda text: document_shingles(text, bits, short)).distinct(), "item-hits")
    hits = hits.withColumn("doc", F.struct("id", "t_hash"))
    candidates = hits.join(sketches(items, threshold), ["h1", "h2"]).where(F.col("n_shingles") >= F.lit(threshold) * F.col("m") - 1e-9)
    candidates = candidates.select("doc", "item").distinct()
    shared = candidates.join(items, "item").join(hits.select("doc", "h1", "h2"), ["doc", "h1", "h2"])
    counted = shared.groupBy("doc", "item", "m").agg(F.count("*").alias("n_shared"))
    found = counted.where(F.col("n_shared") >= F.lit(threshold) * F.col("m") - 1e-9)
    return found.select(
        F.col("doc.id").alias("doc_id"), F.col("doc.t_hash").alias("t_hash"), F.col("item.id").alias("item_id"),
        "n_shared", F.col("m").alias("n_item"), (F.col("n_shared") / F.col("m")).alias("containment"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it contains."""
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("t_hash")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that contain no benchmark item."""
    found = contained(docs, table(spark, sf_dir, "benchmark"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64(whole_text()).alias("t_hash"))
    dirty = found.select(F.col("doc_id").alias("found_id"), F.col("t_hash").alias("found_hash")).distinct()
    same = (F.col("t_hash") == F.col("found_hash")) & F.col("doc_id").eqNullSafe(F.col("found_id"))
    return named.join(dirty, same, "left_anti").select("row.*")


ORACLE_SQL = """
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'i', item_id, coalesce(text, '') FROM benchmark
), listed AS (
    SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM texts
), widths AS (
    SELECT 5 AS width UNION SELECT len(w) FROM listed WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4
), places AS (
    SELECT kind, id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM listed, widths
    WHERE len(w) >= width AND (kind = 'd' OR width = least(len(w), 5))
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + width - 1], ' ') AS s FROM places
), sizes AS (
    SELECT id, count(*) AS n_item FROM shingles WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM shingles d JOIN shingles i ON d.kind = 'd' AND i.kind = 'i' AND d.s = i.s JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id, n_item HAVING count(*) >= 0.8 * n_item
"""
