"""Small documents with every awkward case, and helpers that read results."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names that operators use inside.
CLASHES = ["row", "fp", "uid", "root", "id", "t_hash", "size", "start", "source_key", "score", "kept", "block", "h1", "d2", "key", "gone", "words", "blob", "spans"]

SYLLABLES = "an the re ti on er ing sha lo mi ko da pe ru so".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def text_of(rng, lines, words=14):
    return "\n".join(prose(rng, rng.randint(words - 4, words + 6)) for _ in range(lines))


def awkward(seed=1, n=120):
    """Rows (doc_id, text, lang, source, n_chars): prose, copies, near copies, junk, nulls, empties, a long text."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = text_of(rng, rng.randint(1, 6))
        kind = i % 12
        if kind == 3 and rows:
            text = rng.choice(rows)[1]
        elif kind == 5 and rows and rows[-1][1]:
            words = rows[-1][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 7:
            text = " | ".join(text.split())
        elif kind == 9:
            text = " ".join([rng.choice(text.split())] * 60)
        rows.append((i, text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "b", "b", None, ""]), len(text)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (1002, " \t\n\x0b ", "en", "b", 5), (None, text_of(rng, 2), "en", "b", 1)]
    rows += [(None, None, None, None, None), (2000, text_of(rng, 3000), "en", "b", 1), rows[4], rows[4], (3, "same id, other text " + prose(rng, 20), "en", "a", 1)]
    rows += [(3000, "é ß 😀 " + prose(rng, 30) + "  x", "fr", "ü", 1)]
    return rows


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    return df
