"""SimHash near-duplicates: tiled exact comparison of all fingerprints.

Texts become 64-bit fingerprints over their word shingles. Distinct fingerprints are dealt into tiles by the population
counts of their four 16-bit quarters. Two fingerprints differ in at least as many bits as their quarters' counts
differ, so tiles whose counts differ beyond the radius are never paired; all others are compared by exclusive-or
and bit counts. Links are closed to components.

At scale: equal texts meet as one fingerprint, merged before the shuffle. A tile holds a bounded number
of fingerprints however many share its counts, and each pair of tiles hands on a spanning forest of its links: at most one
link for each fingerprint, also inside a large group of near copies. Which tiles meet is an equi-join on the shifted
counts. Comparing all remains quadratic by its method; the quarters leave about a tenth of all pairs.

Cases: a null or wordless text has fingerprint 0, linked like any other; a text of fewer words than a shingle
has one shingle; null doc_ids count as larger than all others, and a group of them only has a null component;
repeated rows share a fingerprint; an empty table gives an empty result.
"""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.shared import packed, store, table, whole_text
from strata.llm.shingles import hashes, small_batches

SHINGLE = 4
RADIUS = 4
TILE = 2048
QUARTERS = 4
FIELD = 6  # bits for a quarter's count in a tile's key; counts are 0 to 16
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """As a signed 64-bit number. A bit is set if it is set in over half of the shingles' hashes."""
    hashed = hashes(text, width)
    if not len(hashed):
        return 0
    flat = hashed.view(np.uint8).reshape(-1, 8).astype(np.int64) + (np.arange(8) << 8)
    counts = np.bincount(flat.ravel(), minlength=2048).reshape(8, 256) @ BYTE_BITS
    bits = (2 * counts.ravel() > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprinted(docs: DataFrame, carry: list[str] | None, width: int) -> DataFrame:
    """row, fp, and uid, a number of the row."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    row = packed(docs if carry is None else docs.select(*carry))
    rows = docs.select(row, whole_text().alias("s_text")).withColumn("fp", of("s_text")).drop("s_text")
    return store(rows.withColumn("uid", F.monotonically_increasing_id()), "fingerprints")


def counts_key(fp: str):
    """The four quarters' population counts, side by side."""
    quarter = lambda i: F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("bigint")
    return sum((F.shiftleft(quarter(i), FIELD * i) for i in range(1, QUARTERS)), quarter(0))


def shifts(radius: int) -> list[int]:
    """Differences of two keys within the radius, one of each pair of opposites, and 0."""
    moves = [m for m in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, m)) <= radius]
    return [sum(x << (FIELD * i) for i, x in enumerate(m)) for m in moves if m >= (0,) * QUARTERS]


def tiles(fingerprints: DataFrame) -> DataFrame:
    """key, part, fps: at most about TILE fingerprints of equal counts in a tile."""
    keyed = fingerprints.select("fp", counts_key("fp").alias("key"))
    parts = keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    dealt = keyed.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    return dealt.groupBy("key", "part").agg(F.collect_list("fp").alias("fps"))


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest one reached over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        if (label[u] == low).all() and (label[v] == low).all():
            return label
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]


def links_between(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, as pairs of fingerprints."""
    both = np.concatenate((a, b))
    label = np.arange(len(both))
    rows = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at : at + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            # Earlier links take part as node to label.
            known = np.flatnonzero(label != np.arange(len(both)))
            label = forest(np.concatenate((i + at, known)), np.concatenate((j + len(a), label[known])), len(both))
    moved = np.flatnonzero(label != np.arange(len(both)))
    return both[moved], both[label[moved]]


def near_links(fingerprints: DataFrame, radius: int) -> DataFrame:
    """Links `u`, `v` that connect what fingerprints (distinct `fp`) within the radius connect."""
    home = store(tiles(fingerprints), "tiles")
    moves = F.explode(F.array(*[F.lit(s).cast("bigint") for s in shifts(radius)]))
    visits = home.select(F.col("key").alias("key_a"), F.col("part").alias("part_a"), F.col("fps").alias("fps_a"), moves.alias("move"))
    visits = visits.withColumn("key", F.col("key_a") + F.col("move"))
    pairs = visits.join(home, "key").where("move <> 0 or part_a <= part").select("fps_a", "fps")

    def compare(frames):
        for frame in frames:
            u, v = [], []
            for a, b in zip(frame["fps_a"], frame["fps"]):
                x, y = links_between(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), radius)
                if len(x):
                    u.append(x)
                    v.append(y)
            if u:
                yield pd.DataFrame({"u": np.concatenate(u).view(np.int64), "v": np.concatenate(v).view(np.int64)})

    return pairs.mapInPandas(compare, "u bigint, v bigint").where("u <> v")


def near_duplicates(docs: DataFrame, carry: list[str] | None = None, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """row, uid, fp and root (the component's fingerprint) of every document."""
    rows = fingerprinted(docs, carry, width)
    roots = components(near_links(rows.select("fp").distinct(), radius))
    joined = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return joined.withColumn("root", F.coalesce("root", "fp"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"]).withColumn("doc_id", F.col("row.doc_id"))
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return linked.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest doc_id, one row where that repeats."""
    linked = near_duplicates(docs)
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("uid").alias("uid"))
    first = linked.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.uid").alias("uid"))
    return linked.join(first, "uid", "left_semi").select("row.*")
