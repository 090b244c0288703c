"""Word shingles of whole texts as 64-bit hashes, and a bit set of fixed size for looking hashes up in tasks."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

SEED = 42
#: Size of a bit set, whatever it holds: 2 MB. Fuller sets let more rows through to the exact join behind them.
SET_BITS = 24


def small_batches(spark: SparkSession) -> None:
    """Rows may hold long texts: fewer of them in a batch between the JVM and Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def spans(words: list[bytes], width: int) -> tuple[bytes, list[int], list[int]]:
    """The words joined by spaces, and where each shingle begins and ends; fewer words are one shingle, none no shingle."""
    joined = b" ".join(words)
    if len(words) <= width:
        return joined, [0][: len(words)], [len(joined)][: len(words)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return joined, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()


def hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of the UTF-8 of every shingle, repeats included; A-Z are lower-cased."""
    joined, starts, ends = spans(text.encode().lower().split(), width)
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))


def bit_set(column: Column, rows: DataFrame) -> np.ndarray:
    """The top SET_BITS bits of all hashes in `column` as a set; what reaches the driver is 2 MB at most."""
    word = F.shiftrightunsigned(column, 64 - (SET_BITS - 6)).cast("int")
    at = F.shiftrightunsigned(column, 64 - SET_BITS).bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
    found = rows.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(1 << (SET_BITS - 6), np.uint64)
    for word, bits in found:
        out[word] = bits & 0xFFFFFFFFFFFFFFFF
    return out


def in_set(hashed: np.ndarray, bits: np.ndarray) -> np.ndarray:
    top = hashed >> np.uint64(64 - SET_BITS)
    return (bits[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1) == 1
