"""Mixing sources to target weights.

The words of every source are packed, document after document, into blocks of fixed length, numbered from 0.
Targets say how many words of each source the mix holds, and so how many slots. A slot draws its output shard,
which makes a source's counts over the shards multinomial with its total held to the target; slots map
to blocks through a pseudorandom permutation of the source's block numbers, a new one for every pass over
them; slots and blocks join by number.

At scale: a source may hold most rows. Word offsets within a source come from sums over hash buckets of its
documents and a running sum inside each bucket, slots are made in chunks of fixed length, and the join's key is
(source, block), so no task depends on the size of a source. Only tables with a row for each source are
ordered in one task. All draws are keyed hashes: reruns and retried tasks agree.

Cases: a null text has size 0; documents of size 0 and sources without words take no part and have taken 0 (and
target 0); a null source is a source of its own, ordered last; repeated rows are packed one after the other and
each counts; an empty table gives an empty result. A source's taken words differ from its target by less
than two blocks, which is all of the target where a source is that small.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.shared import packed, store, table, whole_text, words

BLOCK = 64
SHARD_SLOTS = 4096
BUCKETS = 4096
CHUNK = 16384
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 42


@dataclass
class Mix:
    """rows: uid (a number of the row), row. documents: uid, source_key, start (first word's number in its source), size.
    sources: source_key, source, source_size, blocks, target, slots, shards.
    slots: source_key, slot, epoch, block, shard, place (order within the shard)."""

    rows: DataFrame
    documents: DataFrame
    sources: DataFrame
    slots: DataFrame


def source_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def targets(sizes: DataFrame, block: int, shard_slots: int) -> DataFrame:
    """Targets of all sources, from `source_key`, `source`, `source_size`.

    Resharing the excess until no source is above its limit ends at the one level where targets are
    min(limit, level * weight) and sum to all words: sources at their limit come first by limit / weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    step = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)))
    step = step.withColumn("ceiling", F.col("source_size").cast("double") * MOST)
    step = step.withColumn("ratio", F.col("ceiling") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("ceiling").over(by_ratio), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))
    step = step.withColumn("level", left / weight)
    open_ = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))
    step = step.withColumn("level", F.min(open_).over(everything)["level"])
    step = step.withColumn("target", F.least(F.col("ceiling"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / block).cast("bigint")
    step = step.withColumn("blocks", blocks)
    slots = F.round(F.col("target") * F.col("blocks") / F.nullif(F.col("source_size"), F.lit(0))).cast("bigint")
    step = step.withColumn("slots", F.coalesce(F.least(slots, MOST * F.col("blocks")), F.lit(0).cast("bigint")))
    shards = F.greatest(F.ceil(F.sum("slots").over(everything) / shard_slots), F.lit(1)).cast("bigint")
    return step.withColumn("shards", shards).select("source_key", "source", "source_size", "blocks", "target", "slots", "shards")


def located(docs: DataFrame, carry: list[str] | None) -> DataFrame:
    """row, uid, source_key, size and place of every document; the order in a source is that of a hash."""
    order = F.xxhash64(F.col("doc_id"), whole_text(), F.col("source"))
    row = packed(docs if carry is None else docs.select(*carry))
    sized = docs.select(
        row,
        source_key("source").alias("source_key"),
        F.col("source").alias("source"),
        F.size(words(whole_text())).cast("bigint").alias("size"),
        order.alias("m_order"),
        F.monotonically_increasing_id().alias("uid"),
    )
    return store(sized.withColumn("m_bucket", F.pmod(F.col("m_order"), F.lit(BUCKETS))), "mix-sizes")


def with_starts(sized: DataFrame) -> DataFrame:
    """Adds `start`: sums over the buckets before, and a running sum within the bucket."""
    bucket = ["source_key", "m_bucket"]
    sums = sized.groupBy(*bucket).agg(F.sum("size").alias("m_words"))
    before = F.sum("m_words").over(Window.partitionBy("source_key").orderBy("m_bucket")) - F.col("m_words")
    bases = sums.select(*bucket, before.alias("m_base"))
    running = Window.partitionBy(*bucket).orderBy("m_order", "size").rowsBetween(Window.unboundedPreceding, 0)
    joined = sized.join(bases, bucket)
    return joined.withColumn("start", F.col("m_base") + F.sum("size").over(running) - F.col("size"))


def mixed64(x: np.ndarray) -> np.ndarray:
    """A fixed avalanche mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, key: np.ndarray, size: int) -> np.ndarray:
    """Numbers below `size` under the pseudorandom permutation of each key.

    Four Feistel rounds on the least even number of bits that holds `size`, repeated while a number falls outside.
    """
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right, k = out[todo] >> bits, out[todo] & mask, key[todo]
        for turn in range(4):
            left, right = right, left ^ (mixed64(right + k + np.uint64(turn) * np.uint64(0x9E3779B97F4A7C15)) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def drawn(sources: DataFrame, seed: int) -> DataFrame:
    """All slots of all sources, in chunks of fixed length."""
    last = F.floor((F.col("slots") - 1) / CHUNK)
    chunks = sources.where("slots > 0").select(
        "source_key", "blocks", "slots", "shards", F.xxhash64(F.lit(seed), F.col("source_key")).alias("key"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk"),
    )

    def slots_of(frames):
        for frame in frames:
            for c in frame.itertuples():
                slot = np.arange(c.chunk * CHUNK, min(c.slots, (c.chunk + 1) * CHUNK), dtype=np.int64)
                epoch = slot // c.blocks
                key = np.uint64(c.key & 0xFFFFFFFFFFFFFFFF)
                with np.errstate(over="ignore"):
                    own = mixed64(epoch.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + key)
                    draw = mixed64(mixed64(slot.astype(np.uint64) + (key ^ np.uint64(0xA0761D6478BD642F))) + key)
                    block = permuted(slot % c.blocks, own, int(c.blocks))
                yield pd.DataFrame({
                    "source_key": c.source_key, "slot": slot, "epoch": epoch, "block": block,
                    "shard": (draw % np.uint64(c.shards)).astype(np.int64), "place": (mixed64(draw) >> np.uint64(1)).astype(np.int64),
                })

    # A given number: chunks are a few bytes each, and the planner would put them all into one task.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(tasks, "source_key", "chunk")
    return spread.mapInPandas(slots_of, "source_key string, slot bigint, epoch bigint, block bigint, shard bigint, place bigint")


def mix(docs: DataFrame, carry: list[str] | None = None, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> Mix:
    """The mix of `docs`; `row` has all columns, or those in `carry`. Only keys and sizes go through the shuffles."""
    sized = located(docs, carry)
    sizes = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    sources = store(targets(sizes, block, shard_slots), "mix-sources")
    documents = with_starts(sized.drop("row", "source")).select("uid", "source_key", "start", "size")
    return Mix(sized.select("uid", "row"), documents, sources, drawn(sources, seed))


def pieces(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The part of each document in each block: `block`, `piece_start` (within the document), `piece_words`."""
    end = F.col("start") + F.col("size")
    spans = documents.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    )
    first = F.greatest(F.col("start"), F.col("block") * block)
    return spans.withColumn("piece_start", first - F.col("start")).withColumn(
        "piece_words", F.least(end, (F.col("block") + 1) * block) - first
    )


def taken(of: Mix, block: int = BLOCK) -> DataFrame:
    """source_key, start, taken, n_shards: the words that the output shards hold of each document with words, repeats counted, and how many
    shards hold some."""
    copies = of.slots.groupBy("source_key", "block", "shard").agg(F.count("*").alias("copies"))
    parts = pieces(of.documents.select("source_key", "start", "size"), block)
    # Slots come from a table of a few rows, so the planner takes them for few: they must never be broadcast.
    joined = parts.join(copies.hint("merge"), ["source_key", "block"])
    by_shard = joined.groupBy("source_key", "start", "shard").agg(F.sum(F.col("piece_words") * F.col("copies")).alias("words"))
    return by_shard.groupBy("source_key", "start").agg(F.sum("words").alias("taken"), F.count("*").alias("n_shards"))


def shard_counts(of: Mix) -> DataFrame:
    """shard, source_key, blocks: how many blocks of each source a shard drew."""
    return of.slots.groupBy("shard", "source_key").agg(F.count("*").alias("blocks"))


def per_document(of: Mix, block: int = BLOCK) -> DataFrame:
    """row, size, source_size, target, taken, n_shards. The rows' own columns move in the last join only."""
    counts = taken(of, block)
    documents = of.documents.withColumn("m_start", F.when(F.col("size") > 0, F.col("start")))
    joined = documents.join(counts.withColumnRenamed("start", "m_start"), ["source_key", "m_start"], "left")
    none = F.lit(0).cast("bigint")
    counted = joined.join(of.sources, "source_key").select(
        "uid", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), F.coalesce("n_shards", none).alias("n_shards")
    )
    return of.rows.join(counted, "uid").drop("uid")


def shards(of: Mix, block: int = BLOCK, text: str = "text") -> DataFrame:
    """The mix itself: a row for each slot with its block's text, in `place` order within `shard`.

    The documents' rows must hold doc_id and the text.
    """
    body = F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    parts = pieces(of.documents.join(of.rows, "uid").withColumn("m_words", words(body)), block)
    part = F.struct(
        "start", F.col("row.doc_id").alias("doc_id"), "piece_start", "piece_words",
        F.array_join(F.slice("m_words", (F.col("piece_start") + 1).cast("int"), F.col("piece_words").cast("int")), " ").alias("text"),
    )
    blocks = parts.groupBy("source_key", "block").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    blocks = blocks.select(
        "source_key", "block",
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece_start"].alias("start"), p["piece_words"].alias("words"))).alias("parts"),
        F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"),
    )
    return of.slots.hint("merge").join(blocks, ["source_key", "block"]).select("shard", "place", "source_key", "epoch", "block", "parts", "text")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_document(mix(table(spark, sf_dir, "documents"), ["doc_id"])).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "n_shards"
    )


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document with the words that the mix takes of it, over the whole corpus 0 to 3 times, and the number of shards
    that hold some. A new column whose name the documents have already is called mix_ and that name."""
    def named(c: str) -> str:
        while c in docs.columns:
            c = f"mix_{c}"
        return c

    new = ("size", "source_size", "target", "taken", "n_shards")
    return per_document(mix(docs)).select(*[F.col(f"row.`{c}`") for c in docs.columns], *[F.col(c).alias(named(c)) for c in new])
