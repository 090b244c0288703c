import random

import corpus
import numpy as np
from strata.llm import line_dedup as ld


def distance(a, b):
    """Words put in, left out or changed."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, order):
    """What stays of each document: rows in the operator's order, each line against all earlier ones."""
    seen, out = [], {}
    for doc in order:
        kept, removed = [], 0
        for line in (doc[1] or "").split("\n"):
            words = line.split()
            near = bool(words) and any(
                w == words or min(len(w), len(words)) >= 5 and abs(len(w) - len(words)) <= 1 and distance(w, words) <= 1 for w in seen
            )
            if words:
                seen.append(words)
            if near:
                removed += 1
            else:
                kept.append(line)
        out[doc[0]] = ("\n".join(kept) if doc[1] is not None else None, removed)
    return out


def lines_rows(seed=2):
    rng = random.Random(seed)
    pool, rows = [], []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.randrange(8)
            words = corpus.prose(rng, rng.choice([1, 3, 4, 5, 6, 9, 10, 11, 16, 25])).split()
            if pool and kind < 4:
                words = list(rng.choice(pool))
                for _ in range(kind):  # up to three edits
                    at = rng.randrange(len(words) + 1)
                    edit = rng.randrange(3)
                    if edit == 0:
                        words.insert(at, "new")
                    elif at < len(words):
                        words[at : at + 1] = [] if edit == 1 and len(words) > 1 else ["other"]
            pool.append(words)
            lines.append(rng.choice([" ", "  ", "\t"]).join(words))
        rows.append((i, "\n".join(lines), "en", "a", 1))
    rows += [(900, "same same same same same same same same same same same", "en", "a", 1), (901, "same same same same same same same same same same", "en", "a", 1)]
    rows += [(902, None, "en", "a", None), (903, "", "en", "a", 0), (904, "\n\n \n", "en", "a", 4), (905, "short line\nshort line", "en", "a", 4)]
    return rows


def test_equals_brute_force(spark):
    rows = lines_rows()
    got = ld.dedup_lines(corpus.frame(spark, rows, clash=True)).select("row.doc_id", "text", "n_removed").collect()
    want = brute(rows, rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["text"], r["n_removed"]) == want[r["doc_id"]], r
    assert sum(r["n_removed"] for r in got) > 25


def test_awkward_rows(spark):
    df = corpus.frame(spark, corpus.awkward(), clash=True)
    out = ld.line_dedup_stage(spark, df, None)
    assert out.columns == df.columns and out.count() == df.count()
    again = ld.line_dedup_stage(spark, df.repartition(5), None)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert out.where("doc_id = 1000").first()["text"] is None


def test_variant_hashes():
    rng = random.Random(3)
    words = [w.encode() for w in corpus.prose(rng, 40).split()]
    whole, without = ld.variants(words)
    for i in range(len(words)):
        assert without[i] == ld.variants(words[:i] + words[i + 1 :])[0]
    assert len(np.unique(without)) == len(words)
    assert whole == ld.variants(list(words))[0]


def test_one_changed_word_in_many_lines(spark):
    rng = random.Random(9)
    words = corpus.prose(rng, 20).split()
    rows = [(i, " ".join(words[:7] + [f"w{i}"] + words[8:]), "en", "a", 1) for i in range(400)]
    df = corpus.frame(spark, rows)
    lines = spark.createDataFrame([(r[0], r[1].split()) for r in rows], "uid bigint, words array<string>")
    assert ld.links(lines).count() < 2 * len(rows)
    left = [r for r in ld.dedup_lines(df).collect() if r["text"]]
    assert len(left) == 1 and left[0]["row"]["doc_id"] == 0


def test_empty(spark):
    assert ld.dedup_lines(corpus.frame(spark, [])).collect() == []
