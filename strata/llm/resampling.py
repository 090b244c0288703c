"""Importance resampling towards the distribution of a target, by hashed runs of one and two words.

Each feature falls into one of BUCKETS buckets by its CRC-32. The gain of a bucket is the logarithm of its share in the target (the items of
`benchmark`) by its share in the documents; a document's weight is the mean gain of its features. A random number keyed by the doc_id turns
weights into a draw without replacement: the documents of greatest score are the sample. The cutoff score comes from `selection`, by
weighted median-of-medians; only the winners are sorted.

At scale: two passes over the texts, in Arrow batches; words' CRCs are remembered, those of word pairs are put together from them for whole
arrays. The first pass sends the sums of all buckets from each task (bounded), the second stores six numbers for each document, and the
texts are never shuffled. Winners are dealt into range partitions by (score, doc_id, row): no task sorts them all, and equal scores
are spread. Counts of buckets (10,000 rows) and one row for each partition and round reach the driver.

Cases: a null or empty text has no features, weight 0, and is never drawn; documents under MIN_WORDS words get a score but no rank; a null
doc_id draws as the text "null" and comes last among equal scores; documents that repeat a doc_id draw the same number, and rows that
are equal in score and doc_id go in the order they were read; other columns take no part; without documents the result is empty; without
target the gains favour buckets that the documents lack.
"""

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.crc import carried
from strata.llm.lexical import terms
from strata.llm.ordering import numbered
from strata.llm.selection import above, cutoff
from strata.llm.shared import store, table, whole_text
from strata.llm.tokens import Known

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
KEY = 7
ROWS = 256
MOST_KNOWN = 300_000
#: Longer second words of a pair are hashed one by one.
MOST_BYTES = 64
SCORED = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def hashed(texts: list[str], known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of words of each text; the texts' features as numbers of their texts and buckets."""
    found = [terms(t) for t in texts]
    n = np.array([len(x) for x in found], np.int64)
    words = [w for x in found for w in x]
    own = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    text = np.repeat(np.arange(len(texts)), n)
    follows = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.empty(0, np.int64)
    # first word and the space, then carried over the second word's bytes
    first = carried(own[follows], np.ones(len(follows), np.int64), 1) ^ np.uint32(crc32(b" "))
    long = lengths[follows + 1] > MOST_BYTES if len(follows) else np.empty(0, bool)
    pairs = carried(first, np.where(long, 0, lengths[follows + 1]) if len(follows) else follows, MOST_BYTES) ^ (own[follows + 1] if len(follows) else own[:0])
    for at in np.flatnonzero(long).tolist():
        i = int(follows[at])
        pairs[at] = crc32(words[i] + b" " + words[i + 1])
    return n, np.concatenate([text, text[follows]]), np.concatenate([own, pairs]) % np.uint32(BUCKETS)


def batches_of_texts(batches):
    """Slices of ROWS rows, and their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            yield some, some["text"].to_pylist()


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features in each bucket, over all rows of `texts` (text)."""

    def count(batches):
        total, known = np.zeros(BUCKETS, np.int64), Known(crc32, MOST_KNOWN)
        for _, found in batches_of_texts(batches):
            total += np.bincount(hashed(found, known)[2], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    partial = texts.select(whole_text().alias("text")).mapInArrow(count, "bucket int, n bigint")
    got = partial.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def bucket_gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target by that in the corpus, rounded down."""
    t_all, s_all = int(target.sum()), int(corpus.sum())
    ratio = lambda t, s: float((t + 1) * (s_all + BUCKETS)) / float((s + 1) * (t_all + BUCKETS))
    return np.array([math.floor(1000 * math.log(ratio(t, s))) for t, s in zip(target.tolist(), corpus.tolist())], np.int64)


def draw(doc_id: int | None, key: int = KEY) -> int:
    """A Gumbel number in thousandths, the same for a doc_id in every run."""
    name = f"{key}:{'null' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, key: int = KEY) -> DataFrame:
    """doc_id, row (a number of the row), n_words, n_features, weight, score of every document; stored."""

    def score(batches):
        known = Known(crc32, MOST_KNOWN)
        for some, found in batches_of_texts(batches):
            n, text, buckets = hashed(found, known)
            features = np.bincount(text, minlength=len(n)).astype(np.int64)
            sums = np.rint(np.bincount(text, gains[buckets], len(n))).astype(np.int64)  # whole numbers below 2**53
            weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
            drawn = np.array([draw(d, key) for d in some["doc_id"].to_pylist()], np.int64)
            numbers = [pa.array(x, pa.int64()) for x in (n, features, weight, weight + drawn)]
            yield pa.RecordBatch.from_arrays([some["doc_id"], *numbers], ["doc_id", "n_words", "n_features", "weight", "score"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    got = chosen.mapInArrow(score, SCORED).withColumn("row", F.monotonically_increasing_id())
    return store(got, "resampling-scores")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, key: int = KEY) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document of `docs`; rank is null for those not drawn.

    Of the documents with at least `min_words` words, `percent` per cent are drawn towards the texts of `target`.
    """
    gains = bucket_gains(bucket_counts(target), bucket_counts(docs))
    scored = scores(docs, gains, key)
    # The order of the draw as three numbers: score downwards, doc_id upwards with null last, row.
    last = F.lit((1 << 63) - 1).cast("bigint")
    keyed = scored.withColumns({"k1": -F.col("score"), "k2": F.coalesce("doc_id", last), "k3": F.col("row")})
    able = F.col("n_words") >= min_words
    least = cutoff(keyed.where(able), percent * scored.where(able).count() // 100)
    shown = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("bigint").alias("rank")
    if least is None:
        return keyed.select(*shown, unranked)
    wins = able & ~above(least)
    winners = numbered(keyed.where(wins).select(*shown, "k1", "k2", "k3"), [F.col(k) for k in ("k1", "k2", "k3")], "rank", "resampling-winners")
    return winners.select(*shown, F.col("rank").cast("bigint")).unionAll(keyed.where(~wins).select(*shown, unranked))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# The CRC of a feature is the exclusive-or of what each byte contributes, by its distance from the end, and of what the start contributes.
ORACLE_SQL = f"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, FALSE AS is_target, {_WORDS} AS words FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, TRUE, {_WORDS} FROM benchmark
),
features AS (
    SELECT row_no, is_target, unnest(list_concat(words, list_transform(list_zip(words[:-2], words[2:]), lambda p: p[1] || ' ' || p[2]))) AS f
    FROM texts WHERE len(words) > 0
),
counted AS (SELECT row_no, is_target, f, count(*) AS n FROM features GROUP BY ALL),
named AS (SELECT f, hex(encode(f)) AS h, octet_length(encode(f)) AS size FROM (SELECT DISTINCT f FROM counted)),
steps AS (
    SELECT b::BIGINT AS b, list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, b::BIGINT) AS t
    FROM (SELECT range AS b FROM range(256))
),
carry AS (
    SELECT 0 AS k, b, t AS z FROM steps
    UNION ALL SELECT k + 1, carry.b, xor(z >> 8, t) FROM carry JOIN steps ON steps.b = z & 255 WHERE k < (SELECT max(size) FROM named)
),
start AS (
    SELECT 0 AS size, 4294967295::BIGINT AS z
    UNION ALL SELECT size + 1, xor(z >> 8, t) FROM start JOIN steps ON steps.b = z & 255 WHERE size < (SELECT max(size) FROM named)
),
bytes AS (
    SELECT f, size, unnest(range(size)) AS i, h FROM named
),
contributed AS (
    SELECT f, any_value(bytes.size) AS size, bit_xor(z) AS z FROM bytes JOIN carry
    ON carry.k = bytes.size - 1 - i AND carry.b = (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1
    GROUP BY f
),
hashed AS (SELECT f, xor(xor(contributed.z, start.z), 4294967295) % {BUCKETS} AS bucket FROM contributed JOIN start USING (size)),
buckets AS (
    SELECT bucket, sum(n) FILTER (WHERE is_target)::BIGINT AS t, sum(n) FILTER (WHERE NOT is_target)::BIGINT AS s
    FROM counted JOIN hashed USING (f) GROUP BY bucket
),
sums AS (SELECT coalesce(sum(n) FILTER (WHERE is_target), 0)::BIGINT AS t, coalesce(sum(n) FILTER (WHERE NOT is_target), 0)::BIGINT AS s FROM counted),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(b.t, 0) + 1) * (sums.s + {BUCKETS})) / ((coalesce(b.s, 0) + 1) * (sums.t + {BUCKETS}))))::BIGINT AS gain
    FROM buckets b, sums
),
weights AS (
    SELECT row_no, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::HUGEINT / sum(n))::BIGINT AS weight
    FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE NOT is_target GROUP BY row_no
),
scored AS (
    SELECT row_no, doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{KEY}:' || coalesce(doc_id::VARCHAR, 'null'))[:8])::BIGINT + 0.5) / 4294967296))))::BIGINT AS score
    FROM texts LEFT JOIN weights USING (row_no) WHERE NOT is_target
),
ranked AS (
    SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id ASC NULLS LAST, row_no) AS place, count(*) OVER () AS total FROM scored WHERE n_words >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * total // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (row_no)
"""
