"""Token ids as binary files: a static range asymmetric numeral system with shared frequency tables.

A folder holds two Parquet tables, committed by Spark. `table` has the frequency of each id over all documents, scaled to parts of 2**20; every
block shares it. `blocks` has the ids of all documents, one after the other in ascending order of doc_id, in blocks of 131,072 ids: the
bytes of `rans`, complete in themselves, with 32 interleaved states, a checkpoint every 8,192 ids, and checksums of the bytes and of the ids.
Beside the bytes stand the part (range of doc_ids), the block's first id within its part, and the documents that have ids in it. `read_documents`
decodes all blocks, each on its own; `read_range` decodes only the segments between the checkpoints that a range of ids needs.

At scale: texts are encoded once, in Arrow batches, and stored as ids of two or four bytes. Documents are dealt into range partitions by
(doc_id, hash of the text, row), so a doc_id that a third of the rows carry is spread over partitions. A task holds 16 blocks at a time, whatever
the length of a document. Only the frequency table (bounded by the vocabulary) and one size for each part reach the driver.
The CRC of a document that spans blocks is an exclusive-or of what its pieces contribute, so no task gathers a long document.

Cases: a null or empty text is its end id alone; a null doc_id comes first; rows with the same doc_id follow each other by the hash of
the text, equal rows in the order they were read; other columns take no part; an empty table makes empty files. Damaged bytes raise
`rans.Damaged`; a document of which a piece is missing raises when it is read.
"""

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from zlib import crc32

from strata.llm import crc, rans
from strata.llm.ordering import bases, in_order, parts
from strata.llm.shared import store, store_path, table, whole_text
from strata.llm.tokens import coder

END = 1
#: Ids in a part, about; a part is one task's work and one file.
PART_IDS = 1 << 26
GROUP = 16
ROWS, TEXTS = 256, 4096
DOCUMENT = "struct<doc_id: bigint, start: bigint, n: bigint>"
BLOCK_ROW = f"part int, first bigint, n bigint, documents array<{DOCUMENT}>, payload binary"


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, tie, row, width (bytes of an id), ids: the whole text's ids with the end id; stored."""

    def encode(batches):
        own = coder(path)
        last = np.array([end], own.dtype).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                ids = [x + last for x in own.encode(some["text"].to_pylist())]
                width = pa.array([own.dtype.itemsize] * len(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([some["doc_id"], some["tie"], width, pa.array(ids, pa.binary())], ["doc_id", "tie", "width", "ids"])

    text = whole_text()
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    got = chosen.mapInArrow(encode, "doc_id bigint, tie bigint, width int, ids binary")
    return store(got.withColumn("row", F.monotonically_increasing_id()), "token-ids")


def id_counts(ids: DataFrame) -> DataFrame:
    """id, n: how often each id occurs."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = np.frombuffer(b"".join(some["ids"].to_pylist()), f"u{some['width'][0]}")
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["id", "n"])

    return ids.select("width", "ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


class Packer:
    """Cuts the documents of a part into blocks, and encodes GROUP full blocks at a time."""

    def __init__(self, shared: rans.Table):
        self.table, self.part = shared, TaskContext.get().partitionId()
        self.pieces: list[np.ndarray] = []
        self.documents: list[tuple] = []  # those with ids in the pieces: doc_id, start, n
        self.held = self.first = self.end = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.documents.append((doc_id, self.end, len(ids)))
        self.end += len(ids)
        most = GROUP * rans.BLOCK
        while len(ids):
            piece = ids[: most - self.held]
            self.pieces.append(piece)
            self.held += len(piece)
            ids = ids[len(piece) :]
            if self.held == most:
                yield self.rows()

    def rows(self) -> pa.RecordBatch:
        ids = np.concatenate(self.pieces)
        blocks = [ids[a : a + rans.BLOCK] for a in range(0, len(ids), rans.BLOCK)]
        firsts = [self.first + a for a in range(0, len(ids), rans.BLOCK)]
        starts = np.array([s for _, s, _ in self.documents])
        ends = starts + np.array([n for _, _, n in self.documents])
        within = []
        for first, block in zip(firsts, blocks):
            a, b = np.searchsorted(ends, first, "right"), np.searchsorted(starts, first + len(block), "left")
            within.append([{"doc_id": d, "start": s, "n": n} for d, s, n in self.documents[a:b]])
        self.first += len(ids)
        self.documents = self.documents[int(np.searchsorted(ends, self.first, "right")) :]
        self.pieces, self.held = [], 0
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.part] * len(blocks), pa.int32()), pa.array(firsts, pa.int64()),
                pa.array([len(b) for b in blocks], pa.int64()), pa.array(within, kind), pa.array(rans.encode(blocks, self.table), pa.binary()),
            ],
            ["part", "first", "n", "documents", "payload"],
        )


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = END) -> None:
    """Writes the ids of `docs` (doc_id, text) by the tokenizer in `path` to the new folder `folder`."""
    spark = docs.sparkSession
    ids = encoded(docs, path, end)
    found = id_counts(ids).toArrow()
    counts = np.zeros(int(max(found["id"].to_numpy(), default=-1)) + 1, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    frequency = rans.frequencies(counts)
    used = np.flatnonzero(frequency)
    rows = spark.createDataFrame(pa.table({"id": pa.array(used, pa.int64()), "frequency": pa.array(frequency[used], pa.int64())}), "id bigint, frequency bigint")
    rows.coalesce(1).write.parquet(f"{folder}/table")

    def pack(batches):
        packer = Packer(rans.Table(frequency))
        for batch in batches:
            for doc_id, width, data in zip(*[batch[c].to_pylist() for c in ("doc_id", "width", "ids")]):
                yield from packer.add(doc_id, np.frombuffer(data, f"u{width}"))
        if packer.held:
            yield packer.rows()

    n = max(parts(spark), -(-int(counts.sum()) // PART_IDS))
    keys = [F.col(c).asc_nulls_first() for c in ("doc_id", "tie", "row")]
    ordered = in_order(ids, keys, n).select("doc_id", "width", "ids")
    # The bytes are coded already.
    ordered.mapInArrow(pack, BLOCK_ROW).write.option("compression", "none").parquet(f"{folder}/blocks")


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK_ROW).parquet(f"{folder}/blocks")


def shared_table(spark: SparkSession, folder: str) -> np.ndarray:
    """The frequencies by id; as many as the vocabulary has ids."""
    got = spark.read.schema("id bigint, frequency bigint").parquet(f"{folder}/table").toArrow()
    ids = got["id"].to_numpy()
    out = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    out[ids] = got["frequency"].to_numpy()
    return out


def part_bases(blocks: DataFrame) -> DataFrame:
    """part, base: ids in all parts before."""
    return bases(blocks.select("part", F.col("n").alias("size")))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers) of every document, by decoding all blocks."""
    frequency, blocks = shared_table(spark, folder), _blocks(spark, folder)

    def read(batches):
        shared = rans.Table(frequency)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                some = batch.slice(at, GROUP)
                part, first, documents = (some[c].to_pylist() for c in ("part", "first", "documents"))
                rows = []
                for p, f, found, symbols in zip(part, first, documents, rans.decode(some["payload"].to_pylist(), shared)):
                    data, end = memoryview(np.ascontiguousarray(symbols, "<u4")).cast("B"), f + len(symbols)
                    for x in found:
                        a, b, last = max(x["start"], f), min(x["start"] + x["n"], end), x["start"] + x["n"]
                        own = crc32(data[4 * (a - f) : 4 * (b - f)])
                        rows.append((p, x["doc_id"], x["start"], x["n"], b - a, own if b == last else crc.carried_far(own, 4 * (last - b))))
                if rows:
                    kinds = [pa.int32(), *[pa.int64()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "doc_id", "start", "n", "here", "crc"])

    pieces = blocks.mapInArrow(read, "part int, doc_id bigint, start bigint, n bigint, here bigint, crc bigint")
    whole = pieces.groupBy("part", "start", "doc_id", "n").agg(F.sum("here").alias("here"), F.bit_xor("crc").alias("ids_crc32"))
    complete = F.when(F.col("here") == F.col("n"), F.col("n")).otherwise(F.raise_error(F.lit("a document's ids are not all there")).cast("bigint"))
    return whole.join(F.broadcast(part_bases(blocks)), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), complete.alias("n_tokens"), "ids_crc32"
    )


def read_range(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """start, ids: ids `first` to `last` (exclusive) of the whole sequence, in pieces; other blocks are not read, other segments not decoded."""
    frequency, blocks = shared_table(spark, folder), _blocks(spark, folder)

    def read(batches):
        shared = rans.Table(frequency)
        for batch in batches:
            for start, data in zip(batch["start"].to_pylist(), batch["payload"].to_pylist()):
                ids = rans.decode_range(data, shared, max(first - start, 0), last - start)
                yield pa.RecordBatch.from_arrays([pa.array([max(start, first)], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["start", "ids"])

    placed = blocks.join(F.broadcast(part_bases(blocks)), "part").withColumn("start", F.col("base") + F.col("first"))
    some = placed.where((F.col("start") < last) & (F.col("start") + F.col("n") > first))
    return some.select("start", "payload").mapInArrow(read, "start bigint, ids array<bigint>")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_documents(spark, folder)
