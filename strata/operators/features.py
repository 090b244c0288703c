"""Model inputs: features and label, split, scaling and their summary."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalars import key_hash
from strata.schemas import FEATURES, LABEL, SPEND_THRESHOLD


def user_features(users: DataFrame, threshold: float = SPEND_THRESHOLD) -> DataFrame:
    """Features, label and id of every user; missing numbers are 0, missing spend is label 0."""
    counts = [c for c in FEATURES if c != "avg_order_value"]
    return (
        users.withColumns({
            "total_spend": F.col("total_spend").cast("double"),
            "avg_order_value": F.col("avg_order_value").cast("double"),
            **{c: F.col(c).cast("bigint") for c in counts},
        })
        .withColumn(LABEL, F.when(F.col("total_spend") > threshold, 1).otherwise(0))
        .fillna(0)
        .select(*FEATURES, LABEL, "user_id")
    )


def class_balance(features: DataFrame) -> DataFrame:
    return features.agg(F.avg(LABEL).alias("positive_share"))


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    key: str = "user_id",
    test: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add `is_test`: in each class exactly round(test * n) rows, those with the smallest
    (hash, key). `key` must be unique. Classes are those of the data; rows without a label are not
    test rows.

    A rank over a whole class would sort half of the data in one task. Instead the rows are
    counted per class and hash bucket (65,536 buckets, so that result is small whatever the
    input), the bucket in which the cut falls is ranked alone, and every row is compared with
    the cut of its class. Both steps give one entry per class, used as a scalar subquery: the
    rows are scanned three times and the wide ones are never shuffled.
    """
    hashed = df.withColumn("_hash", key_hash(F.col(key), seed))
    slim = hashed.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_class"), F.col(key).alias("_key"), "_hash",
        F.shiftright("_hash", 16).alias("_bucket"),
    )
    per_bucket = slim.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_class = Window.partitionBy("_class")
    edges = per_bucket.select(
        "_class", "_bucket", "_n",
        F.sum("_n").over(in_class.orderBy("_bucket")).alias("_upto"),
        F.round(F.sum("_n").over(in_class) * F.lit(float(test))).cast("bigint").alias("_take"),
    ).where("_upto - _n < _take and _take <= _upto")

    edge = F.struct("_bucket", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_rank"))
    edge = F.try_element_at(_by_class(edges, edge), "_class")
    rank = F.row_number().over(in_class.orderBy("_hash", "_key"))
    cuts = (
        slim.where(F.col("_bucket") == edge["_bucket"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") == edge["_rank"])
    )
    cut = F.try_element_at(_by_class(cuts, F.struct("_hash", "_key")), F.col(label))
    below = F.struct(F.col("_hash"), F.col(key).alias("_key")) <= cut
    return hashed.withColumn("is_test", F.coalesce(below, F.lit(False))).drop("_hash")


def _by_class(rows: DataFrame, value: Column) -> Column:
    """Scalar subquery: map from class to value, of rows that are one per class."""
    entries = F.collect_list(F.struct(F.col("_class"), value))
    return rows.agg(F.map_from_entries(entries)).scalar()


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"))


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation of each column."""

    means: dict[str, float]
    deviations: dict[str, float]


def fit_scaler(train: DataFrame, columns: Sequence[str] = FEATURES) -> Scaler:
    """One aggregation over the training rows; two numbers per column reach the driver."""
    row = train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"mean_{c}"] for c in columns}, {c: row[f"dev_{c}"] for c in columns}
    )


def scale(df: DataFrame, scaler: Scaler, prefix: str = "scaled_") -> DataFrame:
    """Add (x - mean) / deviation per column; a constant column is only centred."""
    return df.withColumns({
        prefix + c: (F.col(c) - F.lit(mean)) / F.lit(scaler.deviations[c] or 1.0)
        for c, mean in scaler.means.items()
    })


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
SUMMARY = ("feature", "count", "mean", "std", "min", *QUARTILES, "max")


def summarize(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column.

    The exact `percentile` function keeps a map of all distinct values in one task. Here a
    first pass counts the values; a second takes an approximate quantile on either side of each
    quartile, further away than its rank error and than one rank; a third counts the rows below these
    brackets, and a fourth ranks only the distinct values inside them. Quartiles are interpolated
    linearly between neighbouring values.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    measures = []
    for c in columns:
        x = F.col(c).cast("double")
        margin = 3.0 / accuracy + 2.0 / max(counts[c], 1)
        sides = [p for q in QUARTILES.values() for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
        measures += [
            F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}"), F.min(x).alias(f"min_{c}"),
            F.max(x).alias(f"max_{c}"), F.percentile_approx(x, sides, accuracy).alias(f"at_{c}"),
        ]
    stats = df.agg(*measures).first()
    known = df.sparkSession.createDataFrame(
        [(c, counts[c], *(stats[f"{m}_{c}"] for m in ("mean", "std", "min", "max"))) for c in columns],
        "feature string, count bigint, mean double, std double, min double, max double",
    )
    brackets = [
        (c, name, *stats[f"at_{c}"][2 * i : 2 * i + 2], q * (counts[c] - 1))
        for c in columns if counts[c] for i, (name, q) in enumerate(QUARTILES.items())
    ]
    if not brackets:
        empty = {name: F.lit(None).cast("double") for name in QUARTILES}
        return known.withColumns(empty).select(*SUMMARY)
    below = df.agg(*[
        F.count(F.when(F.col(c) < low, 1)).alias(f"below_{i}") for i, (c, _, low, _, _) in enumerate(brackets)
    ]).first()
    targets = [(*t[:4], t[4] - below[i]) for i, t in enumerate(brackets)]
    return known.join(_at_ranks(tied_values(df, targets), targets), "feature", "left").select(*SUMMARY)


def tied_values(df: DataFrame, targets: list[tuple]) -> DataFrame:
    """Distinct values inside any bracket of their feature, with their number of rows.

    A row makes one entry per feature at most, and equal values are added up before the shuffle.
    """
    inside = {}
    for c, _, low, high, _ in targets:
        inside.setdefault(c, []).append(F.col(c).between(low, high))
    entries = F.array_compact(F.array(*[
        F.when(reduce(or_, tests), F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")))
        for c, tests in inside.items()
    ]))
    values = df.select(F.explode(entries).alias("entry")).select("entry.*")
    return values.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"))


def _at_ranks(values: DataFrame, targets: list[tuple]) -> DataFrame:
    """Per feature, the value at each (fractional) rank counted from the start of its bracket."""
    hits = F.array_compact(F.array(*[
        F.when(
            (F.col("feature") == c) & F.col("x").between(low, high),
            F.struct(F.lit(name).alias("name"), F.lit(rank).alias("rank")),
        )
        for c, name, low, high, rank in targets
    ]))
    ranked = values.select("feature", "x", "n", F.explode(hits).alias("hit")).select("feature", "x", "n", "hit.*")
    upto = F.sum("n").over(Window.partitionBy("feature", "name").orderBy("x"))
    before, after = F.floor("rank"), F.ceil("rank")
    found = ranked.withColumn("upto", upto).groupBy("feature", "name").agg(
        F.min(F.when(F.col("upto") > before, F.col("x"))).alias("left"),
        F.min(F.when(F.col("upto") > after, F.col("x"))).alias("right"),
        F.max(F.col("rank") - before).alias("share"),
    )
    value = F.col("left") + (F.col("right") - F.col("left")) * F.col("share")
    return found.groupBy("feature").agg(*[
        F.max(F.when(F.col("name") == name, value)).alias(name) for name in QUARTILES
    ])
