"""Quality classifier: a generalised additive model with pairwise interactions.

Statistics of each text are cut into bins. Boosting goes round the features in turn; each turn fits a shallow tree on one
feature's bins to the gradient and adds a small share of it to that feature's lookup table. The pairs with the largest gain on what is
left get two-dimensional tables in the same way. A score is the logistic of a sum of table entries.

At scale: fitting reads at most MAX_TRAINING labelled rows, those of the smallest hash, and brings their statistics
(a few numbers a row) to the driver; the model is some thousand numbers. Scoring is one pass without a shuffle.

Cases: null and empty texts have zero statistics and a score like any other; without labelled rows, or with one class only,
the score is the share of label 1 with one row of each class added; null labels are not learnt from; repeated rows are learnt
from and scored each; an empty table gives an empty result. doc_id decides only what is held out (null: not held out).
"""

import itertools
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.shared import packed, store, table, whole_text
from strata.llm.shingles import small_batches

MAX_TRAINING = 20_000
FOLDS = 5
THRESHOLD = 0.3
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 6
RATE, LEAF_WEIGHT = 0.15, 2.0

FEATURES = [
    "log_words", "word_length", "symbol_share", "capital_share", "mark_share", "bar_share", "digit_share", "distinct_words",
    "distinct_pairs", "adjacent_repeats", "repeated_lines", "line_words", "end_share",
]


def statistics(text: str) -> tuple:
    """The statistics of a whole text, in the order of FEATURES."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    chars = sum(map(len, words))
    without = lambda marks: len(raw) - len(raw.translate(None, marks))
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        float(np.log1p(n)), chars / n, without(b"#*$%&<>") / chars, without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars,
        without(b"!?") / n, without(b"|") / n, without(b"0123456789") / chars, len(set(words)) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1), sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), without(b".") / n,
    )


@dataclass
class Additive:
    """edges: upper ends of the bins of each feature; tables by feature; pairs: (feature, feature, edges, edges, table)."""

    intercept: float
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, j], side="left")]
        for a, b, edges_a, edges_b, values in self.pairs:
            out += values[np.searchsorted(edges_a, x[:, a], side="left"), np.searchsorted(edges_b, x[:, b], side="left")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Distinct quantiles between the least and the greatest value."""
    edges = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))
    return edges[edges < x.max()] if len(x) else edges


def split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a row of bins by their gradient and curvature sums: gain, bins to its left (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + LEAF_WEIGHT) + (g.sum() - gl) ** 2 / (h.sum() - hl + LEAF_WEIGHT) - g.sum() ** 2 / (h.sum() + LEAF_WEIGHT)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1 if gain[at] > 1e-9 else 0


def leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + LEAF_WEIGHT))


def tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """The values of a tree of that depth, by bin."""
    _, at = split(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), leaf(g, h))
    return np.concatenate((tree(g[:at], h[:at], depth - 1), tree(g[at:], h[at:], depth - 1)))


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The better of the trees that cut along one axis and then each part along the other: gain, values by cell."""
    best = (0.0, np.zeros_like(g))
    for axis in (0, 1):
        g_, h_ = (g, h) if axis == 0 else (g.T, h.T)
        for at in range(1, len(g_)):
            gain, values = -(g.sum() ** 2) / (h.sum() + LEAF_WEIGHT), np.zeros_like(g_)
            for part in (slice(None, at), slice(at, None)):
                gp, hp = g_[part].sum(axis=0), h_[part].sum(axis=0)
                more, cut = split(gp, hp)
                gain += gp.sum() ** 2 / (hp.sum() + LEAF_WEIGHT) + more
                values[part] = tree(gp, hp, 1) if cut else leaf(gp, hp)
            if gain > best[0]:
                best = (float(gain), values if axis == 0 else values.T)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [cuts(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(model.edges)]
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, bins in enumerate(binned):
            g, h = slopes()
            step = RATE * tree(np.bincount(bins, g, len(model.tables[j])), np.bincount(bins, h, len(model.tables[j])), 2)
            model.tables[j] += step
            margin += step[bins]
    # Pairs by the gain of one tree on what the single features leave.
    coarse = [cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(coarse)]
    shape = lambda a, b: (len(coarse[a]) + 1, len(coarse[b]) + 1)
    sums = lambda a, b, v: np.bincount(cells[a] * shape(a, b)[1] + cells[b], v, np.prod(shape(a, b))).reshape(shape(a, b))
    g, h = slopes()
    gains = [(pair_tree(sums(a, b, g), sums(a, b, h))[0], a, b) for a, b in itertools.combinations(range(x.shape[1]), 2)]
    chosen = [(a, b, np.zeros(shape(a, b))) for gain, a, b in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for a, b, values in chosen:
            g, h = slopes()
            step = RATE * pair_tree(sums(a, b, g), sums(a, b, h))[1]
            values += step
            margin += step[cells[a], cells[b]]
    model.pairs = [(a, b, coarse[a], coarse[b], values) for a, b, values in chosen]
    return model


def remainder(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def with_statistics(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` without their text, with `x`, the statistics."""
    small_batches(rows.sparkSession)

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return rows.withColumn("x", of(text))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """doc_id, text and y of at most `most` labelled rows, those with the smallest hash of doc_id and text; equal rows are one."""
    # A third of the labels may be of one document: labels of a document are one row.
    one = labels.where(F.col(label).isNotNull() & learn).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    told = docs.select("doc_id", F.xxhash64(whole_text()).alias("t_hash")).join(one, "doc_id").distinct()
    chosen = store(told.orderBy(F.xxhash64(F.lit("training"), "doc_id", "t_hash"), "doc_id", "t_hash").limit(most), "training-labels")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("t_hash", F.xxhash64("text"))
    # At most `most` rows of three numbers: bounded, so that texts stay where they are.
    rows = texts.join(F.broadcast(chosen), ["doc_id", "t_hash"]).groupBy("doc_id", "t_hash").agg(F.first("text").alias("text"), F.first("y").alias("y"))
    return rows.select("doc_id", "text", "y")


def quality_model(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_TRAINING) -> Additive:
    """The model learnt from labelled rows that meet `learn` (on the labels' doc_id)."""
    rows = training_rows(docs, labels, "quality", learn, most)
    got = with_statistics(rows, F.col("text")).select("doc_id", "x", "y").orderBy("doc_id", "y", "x").collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def score_quality(docs: DataFrame, model: Additive, carry: list[str] | None = None) -> DataFrame:
    """row (all columns, or those in `carry`) and score of every document."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))))

    row = packed(docs if carry is None else docs.select(*carry))
    return docs.select(row, whole_text().alias("q_text")).withColumn("score", of("q_text")).drop("q_text")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model(docs, labels, remainder(F.col("doc_id"), FOLDS) != 0)
    return score_quality(docs, model, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(remainder(F.col("row.doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
