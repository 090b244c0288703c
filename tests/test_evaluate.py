import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from strata.functions.scalars import segment
from strata.operators import evaluate
from strata.schemas import LABEL


def scored(spark, rows):
    return spark.createDataFrame(rows, f"user_id string, propensity_score double, {LABEL} int, prediction int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 1)), min_size=2, max_size=40).filter(
    lambda x: {y for _, y in x} == {0, 1}))
def test_auc_is_exact_with_ties(spark, pairs):
    df = scored(spark, [(str(i), s / 8, y, 0) for i, (s, y) in enumerate(pairs)])
    assert evaluate.roc_auc(df) == pytest.approx(brute_auc([(s / 8, y) for s, y in pairs]))


def test_auc_of_many_distinct_scores(spark):
    rng = random.Random(2)
    rows = [(str(i), rng.random(), rng.randrange(2), 0) for i in range(3000)]
    assert evaluate.roc_auc(scored(spark, rows)) == pytest.approx(brute_auc([(r[1], r[2]) for r in rows]))


def test_constant_score(spark):
    df = scored(spark, [(str(i), 0.5, i % 2, 0) for i in range(10)])
    assert evaluate.roc_auc(df) == 0.5
    assert sorted(tuple(r) for r in evaluate.histogram(df, "propensity_score").collect()) == [(i, 10 if i == 20 else 0) for i in range(40)]


def test_segments(spark):
    scores = [0.0, 0.33, 0.34, 0.66, 0.67, 1.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r[0] for r in df.select(segment(F.col("s"))).collect()]
    assert got == [None, "low", "medium", "medium", "high", "high", None]


def test_empty_segment_is_listed(spark):
    df = scored(spark, [("a", 0.9, 1, 1), ("b", 0.8, 1, 1), ("c", 0.1, 0, 0), ("d", 0.0, 0, 0)])
    assert [tuple(r) for r in evaluate.segment_distribution(df).collect()] == [("high", 2), ("low", 1), ("medium", 0)]


def test_report_and_matrix(spark):
    truth = [1, 1, 1, 0, 0, 0, 0, 0]
    given_ = [1, 0, 1, 0, 0, 1, 0, 0]
    df = scored(spark, [(str(i), 0.5, y, p) for i, (y, p) in enumerate(zip(truth, given_))])
    got = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert got["high-value"].precision == pytest.approx(2 / 3)
    assert got["high-value"].recall == pytest.approx(2 / 3)
    assert got["normal"].f1_score == pytest.approx(4 / 5)
    assert got["accuracy"].f1_score == 0.75 and got["accuracy"].support == 8
    assert got["macro avg"].precision == pytest.approx((2 / 3 + 4 / 5) / 2)
    assert got["weighted avg"].recall == pytest.approx(0.75)
    cells = {(r.actual, r.predicted): r.rows for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 4, (0, 1): 1, (1, 0): 1, (1, 1): 2}


def test_report_without_positive_predictions(spark):
    df = scored(spark, [("a", 0.1, 1, 0), ("b", 0.1, 0, 0)])
    got = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert tuple(got["high-value"])[1:4] == (0.0, 0.0, 0.0)
    cells = {(r.actual, r.predicted): r.rows for r in evaluate.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_histogram_closes_the_last_bin(spark):
    df = scored(spark, [(str(i), i / 80, 0, 0) for i in range(81)])
    got = {r.bin: r.rows for r in evaluate.histogram(df, "propensity_score").collect()}
    assert sum(got.values()) == 81 and max(got) == 39 and got[39] == 3
    plan = evaluate.histogram(df, "propensity_score")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
