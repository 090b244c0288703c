"""Ranked lexical search by hashed max-sketches: upper bounds first, exact scores only where they may matter.

The index has a row for each document: the number of its terms, its distinct terms with their counts, and a sketch of WIDTH coordinates.
Each term falls on a coordinate by its hash, and the coordinate keeps the greatest impact of the terms there. For a document impact grows
with the count alone, so the greatest count is stored (in a byte; 255 stands for any count from there on) and turned into an impact when the
corpus statistics are known. A batch of items is looked up at once: impacts by coordinate times the items' weights by coordinate give
an upper bound of each item's score in each document. Each task then takes the documents of a block in descending order of bound and
scores them exactly, term by term, until the bound falls below the item's k-th best score so far. All counts are integers and below 2**53,
so bounds in doubles are exact and nothing that could be among the best is passed over.

At scale: the index is made in one pass and shuffles nothing. A search reads it twice for each batch of items: document frequencies of the batch's
terms (partial counts in tasks), then the best k of each item by task, of which a window with a partial limit keeps k. Items come through the
driver in batches of at most BATCH_ITEMS items and BATCH_TERMS terms (an item with more is a batch of its own). A task holds
BLOCK sketches; the terms of a document become a dictionary only when it is scored. Copies and frequent terms meet nowhere.

Cases: a null or empty text has no terms and is found by nothing; items without terms find nothing; items that are equal in id and text are
one item, other texts of an item_id are items of their own; equal scores go by ascending doc_id, null last; repeated documents
are listed each; other columns take no part; an empty table on either side gives an empty result.
"""

import math
from bisect import insort
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.shared import store, table, whole_text
from strata.llm.tokens import Known

WIDTH = 1024
BLOCK = 1024
BEST = 10
BATCH_ITEMS = 512
BATCH_TERMS = 200_000
MOST_KNOWN = 300_000
MANY = 255
#: Bytes that separate terms, A-Z in lower case.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
FOLD = bytes.maketrans(SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(SEPARATORS) + bytes(range(0x61, 0x7B)))
INDEX = "doc_id bigint, n bigint, sketch binary, terms binary, counts binary"


def terms(text: str) -> list[bytes]:
    """All terms of a text, repeats included, as UTF-8."""
    return text.encode().translate(FOLD).split()


def impact(count, share):
    """Integer impact of `count` occurrences in a document whose length weighs `share`; numbers or arrays."""
    return (1_000_000_000 * count) // (1000 * count + 8 * share)


def length_share(n: int, total: int, length: int) -> int:
    """What a document's number of terms weighs: 100 at the mean length."""
    return 100 - 90 + (90 * n * total) // length


def build_index(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The index of `docs` (doc_id, text), stored."""

    def build(batches):
        place = Known(lambda term: crc32(term) % width, MOST_KNOWN)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                rows = []
                for text in some["text"].to_pylist():
                    found = Counter(terms(text))
                    counts = np.fromiter(found.values(), np.uint32, len(found))
                    sketch = np.zeros(width, np.uint8)
                    np.maximum.at(sketch, np.fromiter(map(place.__getitem__, found), np.int64, len(found)), np.minimum(counts, MANY).astype(np.uint8))
                    rows.append((int(counts.sum()), sketch.tobytes(), b" ".join(found), counts.astype("<u4").tobytes()))
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([some["doc_id"], *columns], ["doc_id", "n", "sketch", "terms", "counts"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return store(chosen.mapInArrow(build, INDEX), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and the distinct terms (joined by spaces) of each different item with terms, in a stored order."""

    def split(batches):
        for batch in batches:
            found = [b" ".join(sorted(set(terms(t)))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(found, pa.binary())], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    distinct = items.select("item_id", whole_text().alias("text")).distinct()
    return store(distinct.mapInArrow(split, f"item_id {kind}, terms binary").where(F.length("terms") > 0), "lexical-items")


def batches_of(items: DataFrame):
    """Lists of (item_id, terms), each of a bounded size."""
    batch, size = [], 0
    for row in items.toLocalIterator():
        own = bytes(row["terms"]).split(b" ")
        if batch and (len(batch) >= BATCH_ITEMS or size + len(own) > BATCH_TERMS):
            yield batch
            batch, size = [], 0
        batch.append((row["item_id"], own))
        size += len(own)
    if batch:
        yield batch


def document_frequencies(index: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """In how many documents each term of `vocabulary` (bounded) is."""
    shared = index.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches):
        found = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                for own in batch["terms"].slice(at, BLOCK).to_pylist():
                    found.update(shared.value.intersection(own.split(b" ")))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    partial = index.select("terms").mapInArrow(count, "term binary, n bigint")
    got = partial.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(got["term"].to_pylist(), got["n"].to_pylist()))


class Best:
    """The k best documents of an item: greatest score first, then the least doc_id, null last."""

    def __init__(self, k: int):
        self.k, self.kept = k, []

    def threshold(self) -> int:
        """A score below this cannot be among the best; only scores above 0 count."""
        return -self.kept[-1][0] if len(self.kept) == self.k else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        insort(self.kept, (-score, doc_id is None, doc_id or 0))
        del self.kept[self.k :]


def search_block(block: pa.RecordBatch, items: list[list[tuple[bytes, int]]], weights: np.ndarray, total: int, length: int, best: list[Best]) -> int:
    """Offers the documents of a block to the best of each item; returns how many were scored exactly.

    `items` has the terms and weights of each item, `weights` their sums by coordinate and item.
    """
    counts = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(block.num_rows, -1).astype(np.int64)
    shares = [length_share(n, total, length) for n in block["n"].to_pylist()]
    impacts = np.where(counts == MANY, 1_000_000, impact(counts, np.array(shares)[:, None]))
    bounds = impacts.astype(float) @ weights
    doc_ids = block["doc_id"].to_pylist()
    order = np.argsort(-bounds, axis=0, kind="stable")
    known, scored = {}, 0
    for i, item in enumerate(items):
        bound, own = bounds[:, i], best[i]
        for d in order[:, i].tolist():
            if bound[d] < own.threshold():
                break
            if d not in known:
                known[d] = dict(zip(block["terms"][d].as_py().split(b" "), np.frombuffer(block["counts"][d].as_py(), "<u4").tolist()))
            count, scored = known[d], scored + 1
            score = sum(w * impact(count[t], shares[d]) for t, w in item if t in count)
            if score >= own.threshold():
                own.offer(score, doc_ids[d])
    return scored


def search(index: DataFrame, items: DataFrame, k: int = BEST, width: int = WIDTH) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item (item_id, text) by an index of this width."""
    spark = index.sparkSession
    size = index.where("n > 0").agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    total, length = size["total"], size["length"]
    wanted = item_terms(items)
    kind = wanted.schema["item_id"].dataType.simpleString()
    results = None
    for batch in batches_of(wanted) if total else ():
        vocabulary = sorted({t for _, own in batch for t in own})
        frequency = document_frequencies(index, vocabulary)
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for t, df in frequency.items()}
        shared = spark.sparkContext.broadcast([[(t, weight[t]) for t in own if t in weight] for _, own in batch])

        def find(rows, shared=shared):
            wanted = shared.value
            weights = np.zeros((width, len(wanted)))
            for i, item in enumerate(wanted):
                for t, w in item:
                    weights[crc32(t) % width, i] += w
            best = [Best(k) for _ in wanted]
            for row_batch in rows:
                for at in range(0, row_batch.num_rows, BLOCK):
                    search_block(row_batch.slice(at, BLOCK), wanted, weights, total, length, best)
            found = [(i, None if none else d, -s) for i, own in enumerate(best) for s, none, d in own.kept]
            names, kinds = ["item", "doc_id", "score"], [pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in found], kinds[j]) for j in range(3)], names)

        found = index.where("n > 0").mapInArrow(find, "item int, doc_id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(batch)], f"item int, item_id {kind}")
        part = store(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "lexical-best")
        results = part if results is None else results.unionAll(part)
    return results if results is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLE_SQL = f"""
WITH document_terms AS (SELECT doc_id, row_no, {_TERMS} FROM (SELECT *, row_number() OVER () AS row_no FROM documents)),
counts AS (SELECT doc_id, row_no, term, count(*) AS tf FROM document_terms GROUP BY ALL),
lengths AS (SELECT row_no, sum(tf)::BIGINT AS n FROM counts GROUP BY row_no),
corpus AS (SELECT count(*) AS total, sum(n)::BIGINT AS length FROM lengths),
shares AS (SELECT row_no, 100 - 90 + ((90 * n * total) // length) AS m FROM lengths, corpus),
items AS (SELECT row_number() OVER () AS item_no, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
item_terms AS (SELECT DISTINCT item_no, item_id, term FROM (SELECT item_no, item_id, {_TERMS} FROM items)),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM item_terms) GROUP BY term
),
scores AS (
    SELECT item_no, item_id, row_no, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM item_terms JOIN weights USING (term) JOIN counts USING (term) JOIN shares USING (row_no) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
