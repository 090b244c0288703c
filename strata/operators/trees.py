"""Fitted tree ensembles as tables of nodes: scores and importances that any SQL engine can work out.

A model's nodes come from its own saved form. A row goes left at a node when its feature is not above the threshold. A forest's
score is the mean, over its trees, of the leaf's share of the positive class; that of boosting is the logistic of twice the weighted sum
of the leaves' predictions. A feature's importance is the gain of its splits, weighted by their rows, as a share of all; a forest
takes shares in each tree first.
"""

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A node table of more rows is not broadcast; the walk is the same without.
MOST_BROADCAST = 2_000_000
#: A statement of more nodes is refused: it is meant for small models.
MOST_IN_SQL = 20_000


def node_table(spark: SparkSession, model: Model, path: str) -> DataFrame:
    """One row for each node of a fitted forest or boosting model, which is saved to `path`: tree, weight of the tree, node, feature and
    threshold (NULL for a leaf), left, right, rows (weighted), gain, value (a leaf's contribution to the score)."""
    model.write().overwrite().save(path)
    boosted = isinstance(model, GBTClassificationModel)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    n = F.col("nodeData")
    stats = n["impurityStats"]
    leaf = n["leftChild"] < 0
    classes = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(~leaf, n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(~leaf, n["leftChild"]).alias("left"), F.when(~leaf, n["rightChild"]).alias("right"),
        (F.get(stats, F.lit(0)) if boosted else classes).alias("rows"),
        F.when(~leaf, n["gain"]).alias("gain"),
        (n["prediction"] if boosted else F.try_divide(F.get(stats, F.lit(1)), classes)).alias("value"),
    )
    return nodes.join(F.broadcast(weights), "tree")


def depth_of(nodes: DataFrame) -> int:
    """The number of splits on the longest way from a root to a leaf; a round for each level."""
    edges = nodes.where("feature is not null").select("tree", F.col("node").alias("parent"), F.explode(F.array("left", "right")).alias("node"))
    level, depth = nodes.where("node = 0").select("tree", "node"), 0
    while True:
        level = level.withColumnRenamed("node", "parent").join(edges, ["tree", "parent"]).select("tree", "node")
        if level.isEmpty():
            return depth
        depth += 1


def _scored(total: Column, boosted: bool) -> Column:
    return 1 / (1 + F.exp(-2 * total)) if boosted else total


def walk(inputs: DataFrame, key: str, features: str, nodes: DataFrame, boosted: bool, depth: int) -> DataFrame:
    """`key` and `score` of every row by walking the nodes: `features` is an array column, `depth` the number of levels (or more).

    Every row starts at the root of each tree and takes one join with the node table for each level; the sum over its trees is
    partial in each task. Only the split columns go through the joins.
    """
    n_nodes = nodes.count()
    near = (lambda df: F.broadcast(df)) if n_nodes <= MOST_BROADCAST else (lambda df: df)
    trees = nodes.agg(F.max("tree")).scalar()
    splits = near(nodes.select("tree", "node", "feature", "threshold", "left", "right"))
    at = inputs.select(key, F.col(features).alias("_x")).select(
        key, "_x", F.explode(F.sequence(F.lit(0), F.coalesce(trees, F.lit(0)))).alias("tree"), F.lit(0).alias("node")
    )
    for _ in range(depth):
        on = at.join(splits, ["tree", "node"])
        goes = F.when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = on.select(key, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(goes).alias("node"))
    leaves = near(nodes.select("tree", "node", "weight", "value"))
    reached = at.select(key, "tree", "node").join(leaves, ["tree", "node"])
    total = F.sum(F.col("weight") * F.col("value")) if boosted else F.avg("value")
    return reached.groupBy(key).agg(_scored(total, boosted).alias("score"))


def importance_table(nodes: DataFrame, names: Sequence[str], boosted: bool) -> DataFrame:
    """feature, importance: from the nodes' gains and rows alone."""
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    if not boosted:
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        gains = gains.join(whole, "tree").select("feature", F.try_divide(F.col("gain"), F.col("whole")).alias("gain"))
    sums = gains.groupBy("feature").agg(F.sum("gain").alias("gain"))
    everything = sums.agg(F.sum("gain")).scalar()
    columns = nodes.sparkSession.createDataFrame([(i, name) for i, name in enumerate(names)], "feature int, name string")
    share = F.coalesce(F.try_divide(F.col("gain"), everything), F.lit(0.0))
    return columns.join(sums, "feature", "left").select(F.col("name").alias("feature"), share.alias("importance"))


def score_sql(nodes: DataFrame, names: Sequence[str], boosted: bool) -> str:
    """An SQL expression for the score, over columns `names`: a CASE for each tree. For models of at most MOST_IN_SQL nodes."""
    rows = nodes.limit(MOST_IN_SQL + 1).collect()
    if len(rows) > MOST_IN_SQL:
        raise ValueError(f"a statement is meant for models of at most {MOST_IN_SQL} nodes")
    trees: dict[int, dict] = {}
    for row in rows:
        trees.setdefault(row["tree"], {})[row["node"]] = row

    def case(tree: dict, node: int) -> str:
        row = tree[node]
        if row["feature"] is None:
            return f"CAST({row['value']!r} AS DOUBLE)"
        return f"CASE WHEN {names[row['feature']]} <= {row['threshold']!r} THEN {case(tree, row['left'])} ELSE {case(tree, row['right'])} END"

    terms = [f"{tree[0]['weight']!r} * ({case(tree, 0)})" if boosted else f"({case(tree, 0)})" for _, tree in sorted(trees.items())]
    total = " + ".join(terms) or "0.0"
    return f"1 / (1 + exp(-2 * ({total})))" if boosted else f"({total}) / {max(len(trees), 1)}"
