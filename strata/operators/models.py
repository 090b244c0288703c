"""Three classifiers, their comparison, and scoring. Training is distributed (pyspark.ml)."""

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import segment
from strata.operators.evaluate import roc_auc
from strata.operators.features import Scaler, scale
from strata.schemas import FEATURES, LABEL

BINS = 32
DEPTH = 10
LOGISTIC, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"


@dataclass(frozen=True)
class Fitted:
    """A model with its AUC on the test rows."""

    name: str
    model: Model
    auc: float


def model_inputs(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Add the vectors `raw` and `scaled`; the helper columns go."""
    scaled = [f"scaled_{c}" for c in FEATURES]
    with_raw = VectorAssembler(inputCols=list(FEATURES), outputCol="raw").transform(df)
    both = VectorAssembler(inputCols=scaled, outputCol="scaled").transform(scale(with_raw, scaler))
    return both.drop(*scaled)


def classifiers(n_train: int, trees: int = 100, rounds: int = 100, depth: int = DEPTH) -> dict:
    """The three classifiers in order of preference at equal AUC.

    Fixed values: 1,000 iterations and an inverse regularisation strength of 1 (regParam 1/n); 100 trees; 100
    rounds of depth 3 at rate 0.1; seed 42. Features are cut into BINS candidate splits. A forest's trees are at most `depth` deep, so
    the model has a bounded size (204,700 nodes at most by default) whatever the number of training rows; with 30, the deepest that
    Spark grows, it has as many nodes as the rows ask for. Rows' places in the trees are kept between levels.
    """
    return {
        LOGISTIC: LogisticRegression(
            featuresCol="scaled", labelCol=LABEL, maxIter=1000, elasticNetParam=0.0,
            regParam=1.0 / max(n_train, 1), standardization=False,
        ),
        FOREST: RandomForestClassifier(
            featuresCol="raw", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=42,
            featureSubsetStrategy="sqrt", maxBins=BINS, cacheNodeIds=True, checkpointInterval=10,
        ),
        BOOSTING: GBTClassifier(
            featuresCol="raw", labelCol=LABEL, maxIter=rounds, maxDepth=3, stepSize=0.1, seed=42, maxBins=BINS,
        ),
    }


def score(model: Model, inputs: DataFrame) -> DataFrame:
    """Probability of the positive class and the predicted class of each row."""
    scored = model.transform(inputs)
    return scored.select(
        "user_id", LABEL,
        vector_to_array("probability")[1].alias("propensity_score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def fit_models(train: DataFrame, test: DataFrame, names=None, **sizes) -> list[Fitted]:
    """Fit the (named) classifiers on `train` and measure them on `test`.

    Both frames are read many times, so they should be persisted or stored.
    """
    chosen = {
        name: c for name, c in classifiers(train.count(), **sizes).items()
        if names is None or name in names
    }
    fitted = []
    for name, classifier in chosen.items():
        model = classifier.fit(train)
        fitted.append(Fitted(name, model, roc_auc(score(model, test))))
    return fitted


def best_model(results: list[Fitted]) -> Fitted:
    """Highest AUC; the first one at a tie."""
    return max(results, key=lambda r: r.auc)


def importances(fitted: Fitted, spark) -> DataFrame:
    """Weight of each feature, ascending: tree importances, or coefficients."""
    model = fitted.model
    weights = model.coefficients if fitted.name == LOGISTIC else model.featureImportances
    rows = [(c, float(w)) for c, w in zip(FEATURES, weights.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        "importance", "feature"
    )


def logistic_gradient(model: Model, train: DataFrame) -> DataFrame:
    """Gradient of the logistic objective at the fitted weights: 0 for each feature and the intercept at the optimum."""
    error = vector_to_array("probability")[1] - F.col(LABEL)
    weights = model.coefficients.toArray()
    sums = model.transform(train).withColumn("_x", vector_to_array("scaled")).agg(
        *[(F.sum(error * F.col("_x")[i]) + F.lit(float(w))).alias(c) for i, (c, w) in enumerate(zip(FEATURES, weights))],
        F.sum(error).alias("intercept"),
    )
    rows = [F.struct(F.lit(c).alias("weight"), F.col(c).alias("gradient")) for c in (*FEATURES, "intercept")]
    return sums.select(F.inline(F.array(*rows)))


def score_users(fitted: Fitted, inputs: DataFrame) -> DataFrame:
    """Score and segment of all users."""
    return score(fitted.model, inputs).select(
        "user_id", "propensity_score", segment(F.col("propensity_score")).alias("segment")
    )


def top_propensity(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.orderBy(F.desc("propensity_score"), "user_id").limit(n)
