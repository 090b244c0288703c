import random
import re

import corpus
from strata.llm import decontamination as d

BENCHMARK = "item_id bigint, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(words, width):
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, items):
    """By the task's definition: five words, or all of an item's words where it has fewer."""
    out = set()
    for doc_id, text, *_ in rows:
        words = words_of(text)
        for item_id, item in items:
            width = min(len(words_of(item)), 5)
            t = runs(words_of(item), width) if width else set()
            s = runs(words, width) if width else set()
            if t and 10 * len(s & t) >= 8 * len(t):
                out.add((str(doc_id), item_id, len(s & t), len(t)))
    return out


def cases():
    rng = random.Random(8)
    items = [(i, corpus.prose(rng, rng.choice([5, 6, 12, 30, 33, 64, 70]))) for i in range(40)]
    items += [(100, "too Few words"), (104, "four words stand here"), (105, "zyx"), (106, "never seen"), (101, None), (102, ""), (103, items[0][1]), (None, items[1][1])]
    rows = corpus.awkward()
    rows += [(6000, "there are TOO few\nwords in it", "en", "a", 1), (6001, "four words stand here", "en", "a", 1), (6002, "four words stand", "en", "a", 1)]
    rows += [(6003, "stand here four words stand here too few word", "en", "a", 1), (6004, "zyx", "en", "a", 1)]
    for k in range(80):
        item = rng.choice(items[:40])[1].split()
        kind = k % 4
        if kind == 1:
            item = [w.upper() for w in item]
        elif kind == 2:  # a passage with some words changed: some above, some below the threshold
            for _ in range(max(1, len(item) // 25)):
                item[rng.randrange(len(item))] = "other"
        elif kind == 3:  # torn in two parts
            cut = len(item) // 2
            item = item[cut:] + corpus.prose(rng, 9).split() + item[:cut]
        rows.append((7000 + k, corpus.prose(rng, 50) + " " + " \n".join(item) + " " + corpus.prose(rng, 400), "en", "a", 1))
    return rows, items


def test_equals_brute_force(spark):
    rows, items = cases()
    found = d.contained(corpus.frame(spark, rows, clash=True), spark.createDataFrame(items, BENCHMARK)).collect()
    got = {(str(r["doc_id"]), r["item_id"], r["n_shared"], r["n_item"]) for r in found}
    assert got == brute(rows, items) and len(got) > 50
    assert {("6000", 100, 1, 1), ("6001", 104, 1, 1), ("6003", 104, 1, 1), ("6004", 105, 1, 1)} <= got
    assert not any(x[1] in (101, 102, 106) for x in got)


def test_stage(spark, tmp_path):
    rows, items = cases()
    spark.createDataFrame(items, BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    df = corpus.frame(spark, rows, clash=True)
    out = d.decontamination_stage(spark, df, str(tmp_path))
    assert out.columns == df.columns
    dirty = {x[0] for x in brute(rows, items)}
    assert sorted(str(r["doc_id"]) for r in out.select("doc_id").collect()) == sorted(str(r[0]) for r in rows if str(r[0]) not in dirty)


def test_empty(spark):
    empty, items = corpus.frame(spark, []), spark.createDataFrame([], BENCHMARK)
    some = spark.createDataFrame([(1, "a b c d e f g")], BENCHMARK)
    assert d.contained(empty, some).collect() == []
    assert d.contained(corpus.frame(spark, corpus.awkward()), items).collect() == []
