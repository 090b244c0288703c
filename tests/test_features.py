import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from strata.operators import features
from strata.schemas import FEATURES, LABEL

USERS = """user_id string, total_orders bigint, completed_orders bigint, cancelled_orders bigint,
    total_spend double, avg_order_value double, last_order_ts timestamp,
    unique_products_bought bigint, total_clicks bigint, total_sessions bigint"""


def test_features_of_missing_values(spark):
    users = spark.createDataFrame([
        ("a", 1, 0, 0, None, None, None, 1, None, None),
        ("b", 2, 2, 0, 200.01, 100.0, None, 1, 3, 2),
        ("c", 2, 2, 0, 200.0, 100.0, None, 1, 2**40, 2),
    ], USERS)
    got = {r.user_id: r for r in features.user_features(users).collect()}
    assert [got[u][LABEL] for u in "abc"] == [0, 1, 0]
    assert (got["a"].avg_order_value, got["a"].total_clicks) == (0.0, 0)
    assert got["c"].total_clicks == 2**40
    assert list(got["a"].asDict()) == [*FEATURES, LABEL, "user_id"]


def test_default_threshold_is_a_parameter(spark):
    users = spark.createDataFrame([("b", 2, 2, 0, 300.0, 100.0, None, 1, 3, 2)], USERS)
    assert features.user_features(users, 300.0).first()[LABEL] == 0


def labelled(spark, n, share):
    return spark.range(n).select(
        F.format_string("U%05d", "id").alias("user_id"), (F.col("id") % 100 < share).cast("int").alias(LABEL)
    )


def brute_split(rows, test, seed):
    import hashlib

    chosen = set()
    for label in (0, 1):
        keys = sorted(
            (int(hashlib.md5(f"{k}|{seed}".encode()).hexdigest()[:8], 16), k) for k, l in rows if l == label
        )
        chosen |= {k for _, k in keys[: int(np.floor(test * len(keys) + 0.5))]}
    return chosen


@pytest.mark.parametrize("n,share,test,seed", [
    (1000, 30, 0.2, 42), (1000, 30, 0.2, 7), (997, 1, 0.25, 42), (5, 50, 0.2, 42), (300, 100, 0.2, 42),
    (50, 50, 0.0, 1), (50, 50, 1.0, 1),
])
def test_split_is_exact(spark, n, share, test, seed):
    df = labelled(spark, n, share)
    got = features.stratified_split(df, test=test, seed=seed)
    expected = brute_split([(r.user_id, r[LABEL]) for r in df.collect()], test, seed)
    assert {r.user_id for r in got.collect() if r.is_test} == expected
    assert got.columns == ["user_id", LABEL, "is_test"] and got.count() == n


def test_split_does_not_depend_on_partitioning(spark):
    df = labelled(spark, 500, 40)
    one, many = (features.stratified_split(df.repartition(p)).where("is_test") for p in (1, 13))
    assert sorted(one.collect()) == sorted(many.collect())
    sizes = {r.is_test: r.rows for r in features.split_sizes(features.stratified_split(df)).collect()}
    assert sizes == {True: 100, False: 400}


def test_split_does_not_shuffle_the_rows(spark, tmp_path):
    labelled(spark, 500, 40).withColumn("wide", F.lit("x")).write.parquet(str(tmp_path / "u"))
    df = features.stratified_split(spark.read.parquet(str(tmp_path / "u")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "wide" in main
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scaling_matches_numpy(spark):
    rng = random.Random(5)
    rows = [tuple(float(rng.randrange(100)) for _ in range(2)) + (4.0,) for _ in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    scaler = features.fit_scaler(df, ["a", "b", "c"])
    got = np.array([r[3:] for r in features.scale(df, scaler).collect()])
    x = np.array(rows)
    assert np.allclose(got[:, :2], ((x - x.mean(0)) / np.where(x.std(0) == 0, 1, x.std(0)))[:, :2])
    assert (got[:, 2] == 0).all()


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.integers(-50, 50), min_size=1, max_size=90),
    st.sampled_from([10_000, 30, 12]),
)
def test_summary_matches_pandas(spark, numbers, accuracy):
    rows = [(float(v) / 4, v) for v in numbers]
    df = spark.createDataFrame(rows, "x double, y int").repartition(3)
    got = {r.feature: r for r in features.summarize(df, ["x", "y"], accuracy).collect()}
    want = pd.DataFrame(rows, columns=["x", "y"]).describe()
    for c in ("x", "y"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            a, b = got[c][ours], want[c][theirs]
            assert (a is None and np.isnan(b)) or a == pytest.approx(b), (c, ours)


def test_summary_bracket_on_many_rows(spark):
    df = spark.range(200_000).select(
        (F.xxhash64("id") % 1_000_003 / 7).alias("x"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("hot"),
    )
    got = {r.feature: r for r in features.summarize(df, ["x", "hot"], 1000).collect()}
    want = df.toPandas().describe()
    for c in ("x", "hot"):
        assert [got[c].q25, got[c].q50, got[c].q75] == pytest.approx(list(want[c][["25%", "50%", "75%"]]))


def test_tied_values_are_added_up_before_they_are_spread(spark):
    """Nine rows in ten hold one value: the bracket around it is counted, not copied."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("x"))
    targets = [("x", name, 0.0, 0.0, 0.0) for name in features.QUARTILES]
    assert [tuple(r) for r in features.tied_values(df, targets).collect()] == [("x", 0.0, 18_001)]
    got = features.summarize(df, ["x"]).first()
    assert (got.q25, got.q50, got.q75, got["max"]) == (0.0, 0.0, 0.0, 19_990.0)


def test_large_counts_stay(spark):
    users = spark.createDataFrame([("u", 3_000_000_000, 1.0)], "user_id string, total_clicks bigint, total_spend double")
    users = users.withColumns({c: F.lit(1).cast("bigint") for c in features.FEATURES if c != "total_clicks"})
    assert features.user_features(users).first().total_clicks == 3_000_000_000


def test_split_takes_the_classes_of_the_data(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("user_id"), F.when(F.col("id") % 10 < 9, F.col("id") % 3).alias("is_high_value"))
    counts = {(r[0], r[1]): r[2] for r in features.stratified_split(df).groupBy("is_high_value", "is_test").count().collect()}
    assert counts == {(0, True): 18, (0, False): 72, (1, True): 18, (1, False): 72, (2, True): 18, (2, False): 72, (None, False): 30}


def test_summary_of_nothing(spark):
    got = features.summarize(spark.createDataFrame([], "x double"), ["x"]).first()
    assert got["count"] == 0 and got.q50 is None
