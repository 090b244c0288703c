import re
from collections import Counter

import corpus
from pyspark.sql import functions as F
from strata.llm import quality_rules as q

GAP = re.compile(r"[\x20\x09-\x0D]+")


def base(text):
    words = [w for w in GAP.split(text or "") if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if GAP.sub("", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(s) for s in "#*$%&|<>"), dup, len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(df):
    return q.quality_rules(df).select("row.doc_id", "row.text", *COUNTS, "distance", "kept").collect()


def test_counts_equal_brute_force(spark):
    rows = corpus.awkward() + [
        (1, "a b c d e a b c d e f g h i j k", "en", "a", 1), (2, "x x x x x x", "en", "a", 1), (3, "p\np\n p\n\n\np", "en", "a", 1),
        (4, "1 2 3 4 5 9 1 2 3 4 5 8 2 3 4 5 8", "en", "a", 1),
    ]
    got = judged(corpus.frame(spark, rows, clash=True))
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in COUNTS) == base(r["text"]), r


def test_junk_goes_and_prose_stays(spark):
    import random

    rng = random.Random(5)
    clean = [(i, corpus.text_of(rng, 4), "en", "a" if i % 3 else "b", 1) for i in range(300)]
    junk = [(1000 + i, " ".join(w.upper() + "!! ###" for w in corpus.prose(rng, 60).split()), "en", "a", 1) for i in range(40)]
    kept = {r["doc_id"]: r["kept"] for r in judged(corpus.frame(spark, clean + junk))}
    assert not any(kept[i] for i in range(1000, 1040))
    assert all(kept[i] for i in range(300))


def test_small_groups_lean_on_their_language(spark):
    import random

    rng = random.Random(6)
    rows = [(i, corpus.text_of(rng, 4), "en", f"s{i}", 1) for i in range(60)]
    assert all(r["kept"] for r in judged(corpus.frame(spark, rows)))


def test_repeats_alike_and_stage_columns(spark):
    df = corpus.frame(spark, corpus.awkward(), clash=True)
    out = q.quality_stage(spark, df, None)
    assert out.columns == df.columns
    verdicts = {}
    for r in judged(df):
        verdicts.setdefault((r["doc_id"], r["text"]), set()).add(r["kept"])
    assert all(len(v) == 1 for v in verdicts.values())


def test_empty_table(spark):
    assert judged(corpus.frame(spark, [])) == []


def test_no_python(spark):
    df = corpus.frame(spark, corpus.awkward())
    stats = q.statistics(df, F.col("text"), ["doc_id"])
    assert "Python" not in stats._jdf.queryExecution().toString()
