import random
import re

import corpus
import numpy as np
from pyspark.sql import functions as F
from strata.llm import simhash
from strata.llm.components import components
from xxhash import xxh64_intdigest


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashed = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def brute_components(fingerprints):
    """Smallest doc_id reachable over links of 4 bits or fewer, for rows (doc_id, fingerprint)."""
    n, label = len(fingerprints), list(range(len(fingerprints)))
    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(n):
        for j in range(i):
            if bin(fingerprints[i][1] ^ fingerprints[j][1]).count("1") <= 4:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(fingerprints):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(n)]


def test_hash_is_sparks(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("a b é d")).alias("h")).first()
    assert r["h"] & (2**64 - 1) == xxh64_intdigest("a b é d".encode(), 42)


def test_equals_brute_force(spark, tmp_path):
    rows = corpus.awkward() + [(4000, "One two", "en", "a", 1), (4001, "one TWO", "en", "a", 1), (4002, "É é", "en", "a", 1), (4003, "É É", "en", "a", 1)]
    corpus.frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = simhash.op3_simhash(spark, str(tmp_path)).collect()
    expected = [(r[0], brute_fingerprint(r[1])) for r in rows]
    classes = brute_components(expected)
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(expected, classes))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_all_links_of_random_fingerprints(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(300):
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            f ^= 1 << b
        fps.append(f)
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    got = {r["node"]: r["root"] for r in components(simhash.near_links(df, 4)).collect()}
    masked = [(f, f & (2**64 - 1)) for f in signed]
    want = brute_components(masked)
    assert [got.get(f, f) for f in signed] == want


def test_forest_keeps_what_is_connected():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1, dtype=np.uint64)[0]
    a = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    u, v = simhash.links_between(a[::2], a[1::2], 4)
    assert len(u) == len(a) - 1 and len(set(u.tolist())) == len(u)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 140)} | {201: 200}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rows = corpus.awkward()
    df = corpus.frame(spark, rows, clash=True)
    out = simhash.simhash_stage(spark, df, None)
    assert out.columns == df.columns
    got = out.collect()
    fingerprints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    classes = brute_components(fingerprints)
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == sorted(set(c for c in classes if c is not None))
    assert len(got) == len(set(classes))


def test_empty(spark, tmp_path):
    corpus.frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert simhash.op3_simhash(spark, str(tmp_path)).collect() == []
