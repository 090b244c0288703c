"""Purchase propensity of every user, from gold.user_metrics."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import evaluate
from strata.operators.features import fit_scaler, stratified_split, user_features
from strata.operators.models import Fitted, best_model, fit_models, importances, model_inputs, score, score_users
from strata.schemas import LABEL, SPEND_THRESHOLD
from strata.sources import tables
from strata.sources.files import remove
from strata.sources.scratch import scratch_root


@dataclass(frozen=True)
class Propensity:
    """All models, the best of them, and its results on the test rows and on all users."""

    results: list[Fitted]
    best: Fitted
    inputs: DataFrame
    tested: DataFrame
    scored: DataFrame
    report: DataFrame
    matrix: DataFrame
    importances: DataFrame
    segments: DataFrame
    histogram: DataFrame


def propensity(
    users: DataFrame,
    work: str,
    threshold: float = SPEND_THRESHOLD,
    names: Sequence[str] | None = None,
    **sizes,
) -> Propensity:
    """Features, split, scaling, models; scores of all users and an evaluation by the best model.

    As in the analysis this rebuilds, the model is chosen on the test rows, the label follows
    from two of the features, and training rows are scored too. The split is written once to `work`,
    a folder that all executors share: the models read it many times, and a lost executor does not repeat
    the split. The results read it too; who names the folder removes it.
    """
    spark = users.sparkSession
    path = scratch_root(work, "split")
    stratified_split(user_features(users, threshold)).write.parquet(path)
    split = spark.read.parquet(path)
    scaler = fit_scaler(split.where(~F.col("is_test")))
    inputs = model_inputs(split, scaler).select("user_id", LABEL, "is_test", "raw", "scaled")
    test = inputs.where("is_test")
    results = fit_models(inputs.where(~F.col("is_test")), test, names, **sizes)
    best = best_model(results)
    # Each is read several times below: scored once.
    score(best.model, test).write.parquet(f"{path}-tested")
    score_users(best, inputs).write.parquet(f"{path}-scored")
    tested, scored = spark.read.parquet(f"{path}-tested"), spark.read.parquet(f"{path}-scored")
    return Propensity(
        results, best, inputs, tested, scored,
        evaluate.classification_report(tested), evaluate.confusion_matrix(tested), importances(best, spark),
        evaluate.segment_distribution(scored), evaluate.histogram(scored, "propensity_score"),
    )


def propensity_of(spark: SparkSession, root: str, threshold: float = SPEND_THRESHOLD, **sizes) -> list[Fitted]:
    """The same for the stored gold table; the results become tables of the layer `ml`."""
    work = scratch_root(f"{root.rstrip('/')}/ml", "work")
    try:
        found = propensity(tables.read_table(spark, root, "gold", "user_metrics"), work, threshold, **sizes)
        aucs = spark.createDataFrame(
            [(r.name, r.auc, r.name == found.best.name) for r in found.results], "model string, auc double, best boolean"
        )
        results = {
            "models": aucs, "scored_users": found.scored, "classification_report": found.report,
            "confusion_matrix": found.matrix, "feature_importance": found.importances,
            "segment_distribution": found.segments, "score_histogram": found.histogram,
        }
        for name, rows in results.items():
            tables.write_snapshot(rows, root, "ml", name)
        return found.results
    finally:
        remove(spark, work)
