import random
import re

import corpus
import numpy as np
from strata.llm import mixing as m


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = {s: w for s, w in weight.items() if s not in fixed}
        left = total - sum(fixed.values())
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        above = [s for s in rest if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def check(spark, rows, **options):
    df = corpus.frame(spark, rows)
    got = m.per_document(m.mix(df, **options), **{k: v for k, v in options.items() if k == "block"})
    got = got.select("row.*", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r in got:
        assert r["size"] == size(r["text"])
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
    expected = brute_targets(sizes) if rows else {}
    for s in sizes:
        assert np.isclose(targets[s], expected[s], rtol=1e-9, atol=1e-9)
        assert abs(taken[s] - targets[s]) <= 2 * options.get("block", m.BLOCK)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
    return got


def test_targets_and_counts(spark):
    check(spark, corpus.awkward())
    check(spark, corpus.awkward(2), block=8)


def test_small_sources_stop_at_their_limit(spark):
    rng = random.Random(3)
    rows = [(i, corpus.prose(rng, 100), "en", "z" if i else "a", 1) for i in range(60)]
    got = check(spark, rows, block=4)
    assert all(r["taken"] == 300 for r in got if r["source"] == "a")


def test_reruns_agree(spark):
    df = corpus.frame(spark, corpus.awkward())
    once = sorted(map(str, m.per_document(m.mix(df)).collect()))
    again = sorted(map(str, m.per_document(m.mix(df.repartition(7))).collect()))
    assert once == again


def test_empty_and_wordless(spark):
    assert check(spark, []) == []
    check(spark, [(1, None, None, None, None), (2, " ", "en", "a", 1)])


def test_permutation():
    for n in (1, 2, 3, 17, 64, 1000):
        key = np.full(n, 12345, np.uint64)
        with np.errstate(over="ignore"):
            assert sorted(m.permuted(np.arange(n), key, n)) == list(range(n))


def test_shards_hold_the_texts(spark):
    rows = [r for r in corpus.awkward() if r[0] is not None]
    df = corpus.frame(spark, rows, clash=True)
    mixed = m.mix(df, block=8, shard_slots=32)
    words = {}
    for r in rows:
        words.setdefault(r[0], []).append(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    got = m.shards(mixed, 8).collect()
    assert len(got) == mixed.slots.count()
    counts = {}
    for r in got:
        assert r["text"] == " ".join(r["text"].split(" ")) and sum(p["words"] for p in r["parts"]) <= 8
        if all(len(words[p["doc_id"]]) == 1 for p in r["parts"]):
            assert r["text"].split(" ") == [w for p in r["parts"] for w in words[p["doc_id"]][0][p["start"] : p["start"] + p["words"]]]
        counts[(r["source_key"], r["epoch"], r["block"])] = counts.get((r["source_key"], r["epoch"], r["block"]), 0) + 1
    assert max(counts.values()) == 1


def replayed(mixed, block):
    """Words and shards by document, counted out of the shards' own rows."""
    words, held = {}, {}
    for r in m.shards(mixed, block).collect():
        for p in r["parts"]:
            words[p["doc_id"]] = words.get(p["doc_id"], 0) + p["words"]
            held.setdefault(p["doc_id"], set()).add(r["shard"])
    return words, held


def test_taken_is_what_the_shards_hold(spark):
    rows = list({r[0]: r for r in corpus.awkward() if r[0] is not None}.values())
    mixed = m.mix(corpus.frame(spark, rows), block=8, shard_slots=64)
    words, held = replayed(mixed, 8)
    got = m.per_document(mixed, 8).select("row.doc_id", "taken", "n_shards").collect()
    assert {r["doc_id"]: r["taken"] for r in got if r["taken"]} == words
    assert {r["doc_id"]: r["n_shards"] for r in got if r["n_shards"]} == {d: len(x) for d, x in held.items()}
    drawn = {(r["shard"], r["source_key"]): r["blocks"] for r in m.shard_counts(mixed).collect()}
    assert sum(drawn.values()) == mixed.slots.count() and len({s for s, _ in drawn}) > 3


def test_a_source_with_most_rows(spark):
    rng = random.Random(9)
    rows = [(i, corpus.prose(rng, rng.randint(5, 60)), "en", "hot" if i % 10 else f"s{i % 7}", 1) for i in range(600)]
    check(spark, rows, block=8)
    mixed = m.mix(corpus.frame(spark, rows), block=8, shard_slots=64)
    words, _ = replayed(mixed, 8)
    assert {r["doc_id"]: r["taken"] for r in m.per_document(mixed, 8).select("row.doc_id", "taken").collect() if r["taken"]} == words


def test_stage_keeps_the_documents_own_columns(spark):
    df = corpus.frame(spark, corpus.awkward(), clash=True)
    out = m.mixing_stage(spark, df, None)
    assert out.columns == df.columns + ["mix_size", "source_size", "target", "taken", "n_shards"] and out.count() == df.count()
    assert {r["size"] for r in out.collect()} == {corpus.CLASHES.index("size")}
    assert all(r["mix_size"] == size(r["text"]) for r in out.collect())
