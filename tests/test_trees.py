import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from strata.operators import models, trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(900).select(
        F.col("id").alias("user_id"), (F.col("id") % 7).cast("double").alias("a"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("b"), F.lit(1.0).alias("c"),
        (((F.col("id") % 7) + F.pmod(F.xxhash64("id"), F.lit(5)) > 5)).cast("int").alias("y"),
    )
    return VectorAssembler(inputCols=NAMES, outputCol="raw").transform(made).withColumn("x", vector_to_array("raw")).cache()


@pytest.fixture(scope="module", params=[models.FOREST, models.BOOSTING])
def fitted(request, spark, rows, tmp_path_factory):
    made = models.classifiers(900, trees=7, rounds=6, depth=5)[request.param]
    model = made.setLabelCol("y").fit(rows)
    path = str(tmp_path_factory.mktemp("model") / "m")
    return request.param == models.BOOSTING, model, trees.node_table(spark, model, path).cache()


def close(a, b):
    assert set(a) == set(b) and max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_walk_equals_transform(rows, fitted):
    boosted, model, nodes = fitted
    expected = {r.user_id: r.p for r in model.transform(rows).select("user_id", vector_to_array("probability")[1].alias("p")).collect()}
    depth = trees.depth_of(nodes)
    assert 1 <= depth <= (3 if boosted else 5)
    close({r.user_id: r.score for r in trees.walk(rows, "user_id", "x", nodes, boosted, depth).collect()}, expected)


def test_walk_without_broadcast(rows, fitted, monkeypatch):
    boosted, _, nodes = fitted
    near = {r.user_id: r.score for r in trees.walk(rows, "user_id", "x", nodes, boosted, 5).collect()}
    monkeypatch.setattr(trees, "MOST_BROADCAST", 0)
    close({r.user_id: r.score for r in trees.walk(rows, "user_id", "x", nodes, boosted, 5).collect()}, near)


def test_importances_from_gains(fitted):
    boosted, model, nodes = fitted
    got = {r.feature: r.importance for r in trees.importance_table(nodes, NAMES, boosted).collect()}
    close(got, dict(zip(NAMES, model.featureImportances.toArray().tolist())))
    assert got["c"] == 0.0


DUCK_WALK = """
WITH RECURSIVE walk AS (
    SELECT user_id, x, tree, 0 AS node FROM inputs, (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT user_id, x, walk.tree, CASE WHEN x[feature + 1] <= threshold THEN "left" ELSE "right" END
    FROM walk JOIN nodes USING (tree, node) WHERE feature IS NOT NULL
)
SELECT user_id, {score} AS score FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY user_id
"""


def test_duckdb_works_out_scores_and_importances_from_the_exported_nodes(spark, rows, fitted, tmp_path):
    boosted, model, nodes = fitted
    nodes.write.parquet(f"{tmp_path}/nodes")
    rows.select("user_id", "x", *NAMES).write.parquet(f"{tmp_path}/inputs")
    con = duckdb.connect()
    for name in ("nodes", "inputs"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    expected = {r.user_id: r.p for r in model.transform(rows).select("user_id", vector_to_array("probability")[1].alias("p")).collect()}
    score = "1 / (1 + exp(-2 * sum(weight * value)))" if boosted else "avg(value)"
    close(dict(con.execute(DUCK_WALK.format(score=score)).fetchall()), expected)
    close(dict(con.execute(f"SELECT user_id, {trees.score_sql(nodes, NAMES, boosted)} FROM inputs").fetchall()), expected)
    share = "gain * rows" if boosted else "gain * rows / sum(gain * rows) OVER (PARTITION BY tree)"
    sql = f"SELECT feature, sum(g) / sum(sum(g)) OVER () FROM (SELECT feature, {share} AS g FROM nodes WHERE feature IS NOT NULL) GROUP BY feature"
    got = {NAMES[f]: v for f, v in con.execute(sql).fetchall()}
    close({n: got.get(n, 0.0) for n in NAMES}, dict(zip(NAMES, model.featureImportances.toArray().tolist())))


def test_statement_of_spark_sql(spark, rows, fitted):
    boosted, _, nodes = fitted
    walked = {r.user_id: r.score for r in trees.walk(rows, "user_id", "x", nodes, boosted, 5).collect()}
    close({r.user_id: r.s for r in rows.selectExpr("user_id", f"{trees.score_sql(nodes, NAMES, boosted)} AS s").collect()}, walked)


def test_large_models_have_no_statement(fitted, monkeypatch):
    monkeypatch.setattr(trees, "MOST_IN_SQL", 3)
    with pytest.raises(ValueError, match="at most 3"):
        trees.score_sql(fitted[2], NAMES, fitted[0])


def test_only_roots(spark, rows, tmp_path):
    model = models.classifiers(900, trees=2, depth=4)[models.FOREST].setLabelCol("y").fit(rows.where("y = 1"))
    nodes = trees.node_table(spark, model, str(tmp_path / "m"))
    assert trees.depth_of(nodes) == 0 and nodes.count() == 2
    assert {r.score for r in trees.walk(rows, "user_id", "x", nodes, False, 0).collect()} <= {1.0}
