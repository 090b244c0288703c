import pytest
from pyspark.sql import functions as F
from strata.operators import models
from strata.operators.features import fit_scaler, stratified_split
from strata.plans.propensity import propensity
from strata.schemas import FEATURES, LABEL


@pytest.fixture(scope="module")
def users(spark):
    """Spend, and so the label, follows from the number of completed orders."""
    return spark.range(400).select(
        F.format_string("U%05d", "id").alias("user_id"),
        (F.col("id") % 20 + 1).alias("total_orders"), (F.col("id") % 20).alias("completed_orders"),
        F.lit(1).cast("bigint").alias("cancelled_orders"), (F.col("id") % 20 * 30.0).alias("total_spend"),
        F.when(F.col("id") % 20 > 0, 30.0).alias("avg_order_value"),
        (F.col("id") % 7).alias("unique_products_bought"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 11).alias("total_clicks"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("total_sessions"),
    )


@pytest.fixture(scope="module")
def result(users, tmp_path_factory):
    return propensity(users, str(tmp_path_factory.mktemp("work")), 250.0, trees=5, rounds=3, depth=4)


def test_all_models_learn(result):
    assert [r.name for r in result.results] == [models.LOGISTIC, models.FOREST, models.BOOSTING]
    assert all(r.auc > 0.95 for r in result.results)


def test_best_is_the_first_at_a_tie():
    a, b, c = (models.Fitted(n, None, v) for n, v in (("a", 0.8), ("b", 0.9), ("c", 0.9)))
    assert models.best_model([a, b, c]) is b


def test_all_users_are_scored(result, users):
    rows = result.scored.collect()
    assert {r.user_id for r in rows} == {r.user_id for r in users.collect()}
    assert all(0 <= r.propensity_score <= 1 for r in rows)
    assert result.tested.count() == 80
    top = models.top_propensity(result.scored).collect()
    best = sorted(rows, key=lambda r: (-r.propensity_score, r.user_id))[:10]
    assert [r.user_id for r in top] == [r.user_id for r in best]


def test_evaluation_is_that_of_the_best_model(result):
    assert result.best.auc == max(r.auc for r in result.results)
    assert {r["class"]: r.support for r in result.report.collect()}["accuracy"] == 80
    assert sum(r.rows for r in result.matrix.collect()) == 80
    assert {r.feature for r in result.importances.collect()} == set(FEATURES)
    assert sum(r.users for r in result.segments.collect()) <= 400
    bins = result.histogram.collect()
    assert len(bins) == 40 and sum(r.rows for r in bins) == 400


def test_a_shared_folder_is_needed(users):
    with pytest.raises(ValueError, match="shared folder"):
        propensity(users, "", 250.0)


def test_importances(result, spark):
    for fitted in result.results:
        rows = models.importances(fitted, spark).collect()
        assert {r.feature for r in rows} == set(FEATURES)
        assert [r.importance for r in rows] == sorted(r.importance for r in rows)


def test_logistic_matches_its_objective(spark):
    """Coefficients minimise log-loss sum + half the squared weights (inverse strength 1)."""
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 7))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame(
        [(*map(float, r), int(v), str(i)) for i, (r, v) in enumerate(zip(x, y))],
        ", ".join(f"{c} double" for c in FEATURES) + f", {LABEL} int, user_id string",
    )
    inputs = models.model_inputs(df, fit_scaler(df))
    model = models.classifiers(300)[models.LOGISTIC].fit(inputs)
    scaled = (x - x.mean(0)) / x.std(0)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(scaled @ w + b)))
    assert np.abs(scaled.T @ (p - y) + w).max() < 0.05 and abs((p - y).sum()) < 0.05


def test_scoring_stays_in_the_jvm(result):
    plan = result.scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_split_never_leaks(users):
    from strata.operators.features import user_features

    split = stratified_split(user_features(users, 250.0))
    assert split.groupBy("user_id").count().where("count > 1").count() == 0
