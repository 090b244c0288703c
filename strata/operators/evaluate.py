"""Quality of scores and classes, and the distribution of scores."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import SEGMENTS, segment
from strata.schemas import LABEL


def roc_auc(df: DataFrame, score: str = "propensity_score", label: str = LABEL) -> float:
    """Exact area under the ROC curve; equal scores count one half.

    numBins=0 keeps every distinct score (the default thins them out to 1,000). The scores are
    range-sorted over the cluster; only per-partition counts reach the driver.
    """
    scored = df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label))
    return BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def _cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row with the four counts; absent cells are 0."""
    return df.agg(*[
        F.count(F.when((F.col(label) == actual) & (F.col(prediction) == given), 1)).alias(name)
        for name, actual, given in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ])


def confusion_matrix(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Rows per (actual, predicted) class, zero cells included."""
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("rows"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
    return _cells(df, label, prediction).select(F.inline(F.array(*cells)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(F.try_divide(part, whole))


def classification_report(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, f1 and support per class, accuracy, and both averages; 0/0 is 0.

    The accuracy row holds the accuracy in f1_score and NULL in the two columns before it.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    counts = _cells(df, label, prediction)

    def measures(hit: Column, wrongly: Column, missed: Column) -> list[Column]:
        return [
            _ratio(hit, hit + wrongly), _ratio(hit, hit + missed),
            _ratio(2 * hit, 2 * hit + wrongly + missed), hit + missed,
        ]

    normal, high = measures(tn, fn, fp), measures(tp, fp, fn)
    total = tn + fp + fn + tp
    macro = [(a + b) / 2 for a, b in zip(normal[:3], high[:3])]
    weighted = [_ratio(a * normal[3] + b * high[3], total) for a, b in zip(normal[:3], high[:3])]
    none = F.lit(None).cast("double")
    lines = {
        "normal": normal,
        "high-value": high,
        "accuracy": [none, none, _ratio(tn + tp, total), total],
        "macro avg": [*macro, total],
        "weighted avg": [*weighted, total],
    }
    names = ("precision", "recall", "f1_score", "support")
    rows = [
        F.struct(F.lit(name).alias("class"), *[v.alias(n) for v, n in zip(values, names)])
        for name, values in lines.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def segment_distribution(df: DataFrame, score: str = "propensity_score") -> DataFrame:
    """Users per segment, most first. An empty segment is listed, users without one are not."""
    counted = df.select(segment(F.col(score)).alias("_segment")).agg(*[
        F.count(F.when(F.col("_segment") == name, 1)).alias(name) for name, _, _ in SEGMENTS
    ])
    rows = [F.struct(F.lit(n).alias("segment"), F.col(n).alias("users")) for n, _, _ in SEGMENTS]
    return counted.select(F.inline(F.array(*rows))).orderBy(F.desc("users"), "segment")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Rows per equal-width bin over [min, max], the last bin closed; all bins, also empty ones.

    The range is a scalar subquery. A constant column has the range of one unit around its value.
    """
    x = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high"))).scalar()
    half = F.when(span["low"] == span["high"], 0.5).otherwise(0.0)
    low, high = span["low"] - half, span["high"] + half
    place = F.floor(F.try_divide(x - low, high - low) * bins)
    placed = df.where(F.col(column).isNotNull()).select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))
