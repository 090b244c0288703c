"""Line dedup by a deletion-neighbourhood join: the earliest of near-equal lines stays.

Lines are sequences of words (white space aside) and are ordered by doc_id (null last), hash of the text and place. A
line with a word goes if an earlier line is equal, or, from EDIT_WORDS words on, within one edit: one word put
in, left out or changed. Blank lines stay.

Every line emits its variants, itself and all results of leaving out one word, as hashed keys. Lines of one length that agree
when the word at one place is left out are one edit apart, and so are a line and a line that equals it with one word left out. So
a group of equal variants needs no pairs: each member is linked to the earliest (or to the whole line), and the
edit distance of these links is verified on the words.

At scale: equal lines are first merged to one row of hashes. Two lines one edit apart agree in their first or last half, so only
lines that share a hashed half with another distinct line emit variants; variant hashes cost constant time each. Texts of
these lines, and variants that more than one line has, are found again through bit sets of fixed size, so what is shuffled
is a hash and a number for each variant once. Links are one for each member of a group, whatever its size; hot
lines are large sides of joins, which Spark splits.

Cases: null texts stay null; empty and wordless texts stay as they are; a text
whose lines all go becomes empty; repeated rows (same doc_id and text) are one document and stay or lose lines alike; an
empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_digest, xxh64_intdigest

from strata.llm.shared import packed, store, table, whole_text
from strata.llm.shingles import bit_set, in_set, small_batches

#: In shorter lines one word is more than a fifth: they must be equal.
EDIT_WORDS = 5
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

LINE = "no_id boolean, id bigint, t_hash bigint, line_no bigint, k1 bigint, k2 bigint"
PLACE = ["no_id", "id", "t_hash", "line_no"]
KEY = ["k1", "k2"]
HALVES = ["p1", "s1", "p2", "s2"]


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def numbers(digests: list[bytes], columns: int) -> np.ndarray:
    """Rows of signed 64-bit numbers out of digests."""
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, columns)


def line_words(text: str) -> list[list[bytes]]:
    return [line.split() for line in text.encode().split(b"\n")]


def line_key(words: list[bytes]) -> bytes:
    return xxh3_128_digest(b" ".join(words))


def halves(words: list[bytes]) -> bytes:
    """Four hashes: of the first and last half, of both lengths that a line one word longer or shorter may share."""
    n = len(words)
    if n < EDIT_WORDS:
        return bytes(32)
    q = n // 2
    both = xxh64_digest(b" ".join(words[:q]), 2 * q) + xxh64_digest(b" ".join(words[n - q :]), 2 * q + 1)
    if n % 2:
        return both + both
    q -= 1
    return both + xxh64_digest(b" ".join(words[:q]), 2 * q) + xxh64_digest(b" ".join(words[n - q :]), 2 * q + 1)


def variants(words: list[bytes]) -> tuple[int, np.ndarray]:
    """The hash of the words, and the hash of the words without each one: sums of word hashes times powers of BASE."""
    n = len(words)
    hashed = np.fromiter((xxh64_intdigest(w, 5) for w in words), np.uint64, n)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.array([1] + [BASE] * (n - 1), np.uint64), dtype=np.uint64)
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashed * powers, dtype=np.uint64)))
        without = upto[:-1] + (upto[-1] - upto[1:]) * np.uint64(INVERSE)
    return signed(int(upto[-1])), without.view(np.int64)


def keyed_rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("id"),
        F.xxhash64(whole_text()).alias("t_hash"), whole_text().alias("text"),
    )


def placed(frame: pd.DataFrame, lines: list[list[tuple]]) -> pd.DataFrame:
    """The document's columns for each of its lines, and the lines' numbers."""
    counts = [len(x) for x in lines]
    out = {c: np.repeat(frame[c].to_numpy(), counts) for c in ("no_id", "id", "t_hash")}
    return pd.DataFrame(out | {"line_no": np.array([i for x in lines for i, _ in x], np.int64)})


def lines_of(rows: DataFrame) -> DataFrame:
    """A row for each line that takes part: its place, key, number of words and hashes of its halves."""

    def of(frames):
        for frame in frames:
            lines = [[(i, w) for i, w in enumerate(line_words(t)) if w] for t in frame["text"]]
            every = [w for x in lines for _, w in x]
            if every:
                out = placed(frame, lines)
                out[KEY] = numbers([line_key(w) for w in every], 2)
                out["n"] = [len(w) for w in every]
                out[HALVES] = numbers([halves(w) for w in every], 4)
                yield out

    return rows.mapInPandas(of, LINE + ", n int, " + ", ".join(f"{h} bigint" for h in HALVES))


def texts_of(rows: DataFrame, bits: np.ndarray, text_bits: np.ndarray) -> DataFrame:
    """Place, key and words of the lines whose key is in the bit set, of texts whose hash is in theirs."""

    def of(frames):
        for frame in frames:
            frame = frame[in_set(frame["t_hash"].to_numpy().view(np.uint64), text_bits)]
            lines = [[(i, w) for i, w in enumerate(line_words(t)) if len(w) >= EDIT_WORDS] for t in frame["text"]]
            every = [w for x in lines for _, w in x]
            if every:
                keys = numbers([line_key(w) for w in every], 2)
                hit = np.flatnonzero(in_set(keys[:, 0].view(np.uint64), bits))
                out = placed(frame, lines).iloc[hit].copy()
                out[KEY] = keys[hit]
                out["words"] = [b" ".join(every[i]).decode().split(" ") for i in hit.tolist()]
                yield out

    return rows.mapInPandas(of, LINE + ", words array<string>")


def spread_key(hashed: np.ndarray, place_: np.ndarray, n: int) -> np.ndarray:
    """The hash of a variant with the place of the word left out (-1: any) and the number of words, evenly spread."""
    with np.errstate(over="ignore"):
        x = hashed.view(np.uint64) + place_.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(n) * np.uint64(0xA0761D6478BD642F)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def changed_keys(whole: int, without: np.ndarray) -> np.ndarray:
    """Keys that lines of one length share if they differ at one place only."""
    return spread_key(without, np.arange(len(without)), len(without))


def whole_key(whole: int, without: np.ndarray) -> np.ndarray:
    return spread_key(np.array([whole], np.int64), np.array([-1]), len(without))


def shorter_keys(whole: int, without: np.ndarray) -> np.ndarray:
    """Keys of the lines that this line becomes by leaving out one word."""
    shorter = np.unique(without)
    return spread_key(shorter, np.full(len(shorter), -1), len(without) - 1)


def variant_rows(lines: DataFrame, keys, bits: np.ndarray | None = None) -> DataFrame:
    """`key` and `uid` of the variants of `lines` (uid, words), those in the bit set if one is given."""

    def of(frames):
        for frame in frames:
            made = [keys(*variants([w.encode() for w in words])) for words in frame["words"]]
            if made:
                key, uid = np.concatenate(made), np.repeat(frame["uid"].to_numpy(), [len(m) for m in made])
                keep = slice(None) if bits is None else in_set(key, bits)
                yield pd.DataFrame({"key": key[keep].view(np.int64), "uid": uid[keep]})

    return lines.select("uid", "words").mapInPandas(of, "key bigint, uid bigint")


def place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in PLACE])


def links(lines: DataFrame) -> DataFrame:
    """Pairs `a`, `b` of lines (uid, words) that share a variant: each member with one other of its group.

    Variants that are alone are counted and then left out: a second pass makes only those that the bit set of
    shared ones holds.
    """
    shared = variant_rows(lines, changed_keys).groupBy("key").agg(F.min("uid").alias("a"), F.count("*").alias("members"))
    shared = store(shared.where("members > 1").select("key", "a"), "lines-changed")
    changed = variant_rows(lines, changed_keys, bit_set(F.col("key"), shared)).join(shared, "key")
    whole = store(variant_rows(lines, whole_key).withColumnRenamed("uid", "a"), "lines-whole")
    shorter = variant_rows(lines, shorter_keys, bit_set(F.col("key"), whole)).join(whole, "key")
    return changed.unionByName(shorter).where("a <> uid").select("a", F.col("uid").alias("b")).distinct()


def one_edit(a: Column, b: Column) -> Column:
    """Whether b is a with one word changed, or with one word put in."""
    # The first place where they differ; beyond the end of a, the end.
    common = F.aggregate(
        F.sequence(F.lit(0), F.size(a) - 1), F.lit(0),
        lambda upto, i: F.when((upto == i) & (F.get(a, i) == F.get(b, i)), i + 1).otherwise(upto),
    )
    rest = lambda words, start: F.slice(words, start + 1, F.greatest(F.size(words) - start, F.lit(0)))
    same_length = (F.size(a) == F.size(b)) & (rest(a, common + 1) == rest(b, common + 1))
    longer = (F.size(b) == F.size(a) + 1) & (rest(a, common) == rest(b, common + 1))
    return same_length | longer


def near_earlier(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """Keys of the distinct lines that are within one edit of an earlier line."""
    halves_ = distinct.where(F.col("n") >= EDIT_WORDS).select(*KEY, F.explode(F.array_distinct(F.array(*HALVES))).alias("half"))
    shared = halves_.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1").select("half")
    chosen = halves_.join(shared, "half", "left_semi").select(*KEY).distinct()
    chosen = store(chosen.join(distinct.select(*KEY, "first"), KEY), "lines-chosen")
    words = texts_of(keyed_rows(docs), bit_set(F.col("k1"), chosen), bit_set(F.col("first.t_hash"), chosen))
    words = words.join(chosen, KEY).where(place() == F.col("first")).drop("first").dropDuplicates(KEY)
    # Numbers in the order of the lines, so that the smaller one is the earlier line.
    words = store(words.orderBy(*PLACE, *KEY).withColumn("uid", F.monotonically_increasing_id()), "lines-words")
    texts = words.select("uid", "words")
    linked = links(words)
    linked = linked.join(texts.select(F.col("uid").alias("a"), F.col("words").alias("words_a")), "a")
    linked = linked.join(texts.select(F.col("uid").alias("b"), F.col("words").alias("words_b")), "b")
    first_shorter = F.size("words_a") <= F.size("words_b")
    near = F.when(first_shorter, one_edit(F.col("words_a"), F.col("words_b"))).otherwise(one_edit(F.col("words_b"), F.col("words_a")))
    later = linked.where(near).select(F.greatest("a", "b").alias("uid")).distinct()
    return words.join(later, "uid", "left_semi").select(*KEY)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """no_id, id, t_hash, line_no of all lines that go."""
    lines = store(lines_of(keyed_rows(docs)), "lines")
    distinct = lines.groupBy(*KEY, "n", *HALVES).agg(F.min(place()).alias("first"), F.count("*").alias("copies"))
    distinct = store(distinct, "lines-distinct")
    near = near_earlier(docs, distinct).withColumn("near", F.lit(True))
    fate = distinct.select(*KEY, "first", "copies").join(near, KEY, "left").where("near or copies > 1")
    gone = lines.select(*PLACE, *KEY).join(fate, KEY).where(F.coalesce("near", F.lit(False)) | (place() != F.col("first")))
    return gone.select(*PLACE).distinct()


def dedup_lines(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """row (all columns, or those in `carry`), text (what stays) and n_removed of every document."""
    gone = repeated_lines(docs).groupBy("no_id", "id", "t_hash").agg(F.collect_list("line_no").alias("gone"))
    row = packed(docs if carry is None else docs.select(*carry))
    rows = docs.select(
        row, F.col("text").cast("string").alias("text"), F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("id"), F.xxhash64(whole_text()).alias("t_hash"),
    )

    @F.pandas_udf("string")
    def without(texts: pd.Series, lines: pd.Series) -> pd.Series:
        out = []
        for text, numbers_ in zip(texts, lines):
            if text is not None:
                drop = set(numbers_)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
            out.append(text)
        return pd.Series(out, dtype=object)

    # Texts that keep all their lines do not go through Python.
    joined = rows.join(gone, ["no_id", "id", "t_hash"], "left")
    changed = without(F.when(F.col("gone").isNotNull(), F.col("text")), "gone")
    return joined.select(
        "row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(changed).alias("text"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document."""
    return dedup_lines(table(spark, sf_dir, "documents"), ["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "n_removed", "text")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with the lines that stay; n_chars follows the text."""
    kept = dedup_lines(docs)
    chars = F.length("text").cast("bigint")
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, chars).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
