"""Queries of the library over the given tables, and their DuckDB counterparts.

Each query derives the order and click topics from the tables and runs the operator over all of
them. Times stamped by the clock are dropped from the results, event times are shown without zone.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import derived_topics  # noqa: E402
import oracle  # noqa: E402
from strata.functions import money, scalars  # noqa: E402
from strata.operators import (  # noqa: E402
    distinct, evaluate, events, explore, features, gold, models, silver, trees,
)
from strata.plans.propensity import propensity  # noqa: E402
from strata.plans import dated, visitors  # noqa: E402
from strata.plans.incremental import extend_silver  # noqa: E402
from strata.plans.refresh import refresh_gold  # noqa: E402
from strata.plans.run import run_once  # noqa: E402
from strata.schemas import CLICK_PAYLOAD, FEATURES, LABEL, ORDER_PAYLOAD  # noqa: E402
from strata.sources import layout, tables  # noqa: E402
from strata.sources.files import matching, remove  # noqa: E402
from strata.sources.scratch import scratch_root  # noqa: E402
from strata.streaming import ingest  # noqa: E402
from strata.streaming.reports import reports  # noqa: E402

try:
    from strata.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("strata.llm", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMALLEST = "/root/testdata/sf0.001"
MONTH = "month"  # The given events lie thinly over years: folders of months.
THRESHOLD = 500_000.0  # The given prices are far above those the default of 200 is meant for.


def place(spark, purpose):
    """A folder for a query's own tables, in the shared folder that the cluster names; a local one in tests."""
    return scratch_root(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="strata-"), purpose)


# Layers, derived lazily from the tables.

def bronze_orders(spark, sf):
    return events.to_bronze(derived_topics.order_records(spark, sf))


def bronze_clicks(spark, sf):
    return events.to_bronze(derived_topics.click_records(spark, sf))


def orders(spark, sf, *fields):
    """Clean orders; with `fields` only these are parsed."""
    return silver.silver_orders(bronze_orders(spark, sf), None, fields or None)


def clicks(spark, sf, *fields):
    return silver.silver_clicks(bronze_clicks(spark, sf), None, fields or None)


def daily(spark, sf):
    return gold.daily_revenue(orders(spark, sf, "user_id"))


def products(spark, sf):
    return gold.product_metrics(
        orders(spark, sf, "user_id", "product_id", "product_name", "category", "unit_price", "quantity")
    )


def buyers(spark, sf):
    return orders(spark, sf, "user_id", "product_id")


def users(spark, sf):
    return gold.user_metrics(buyers(spark, sf), clicks(spark, sf, "user_id", "session_id", "converted"))


def pages(spark, sf):
    return gold.funnel(clicks(spark, sf, "user_id", "session_id", "page", "converted"))


def parsed_orders(spark, sf):
    return silver.parse_payload(bronze_orders(spark, sf), ORDER_PAYLOAD)


def parsed_clicks(spark, sf):
    return silver.parse_payload(bronze_clicks(spark, sf), CLICK_PAYLOAD)


def shown(df: DataFrame) -> DataFrame:
    """Without clock columns; times without zone; names free of SQL keywords."""
    df = df.drop("ingested_at", "processed_at", "updated_at")
    return df.select([
        (F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else F.col(f.name))
        .alias({"partition": "part_no", "offset": "off_no"}.get(f.name, f.name))
        for f in df.schema.fields
    ])


def stored_users(spark, sf):
    """user_metrics as a stored table, since splitting and fitting scan it several times."""
    root = place(spark, "users")
    tables.write_snapshot(users(spark, sf), root, "gold", "user_metrics")
    return root, tables.read_table(spark, root, "gold", "user_metrics")


def user_features(spark, sf):
    return features.user_features(users(spark, sf), THRESHOLD)


def split(spark, sf):
    return features.stratified_split(features.user_features(stored_users(spark, sf)[1], THRESHOLD))


def pseudo_scored(spark, sf, users_table=None):
    """Users with a score that any engine can reproduce, many ties, 0 and 1 included."""
    bucket = scalars.key_hash(F.col("user_id"), 42) % 101
    rows = users(spark, sf) if users_table is None else users_table
    return features.user_features(rows, THRESHOLD).select(
        "user_id", LABEL, (bucket / F.lit(100.0)).alias("score"),
        (bucket >= 50).cast("int").alias("prediction"),
    )


# Sources, sinks, streaming: through storage.

def stored_topics(spark, sf, names=("orders", "clicks")):
    """Both topics as record files, and a fresh root for the layers."""
    root = place(spark, "layers")
    build = {"orders": derived_topics.order_records, "clicks": derived_topics.click_records}
    for name in names:
        send(root, name, build[name](spark, sf))
    return root


def send(root, name, records):
    """Records are added to a topic."""
    tables.write_files(records, f"{root}/topics/{name}", "append")


def expire(spark, root, name):
    """The records of a topic go, all of which bronze has: no step reads them again, and they would lie on the disks beside all layers."""
    remove(spark, f"{root}/topics/{name}")


def stream_topics(spark, root, topics=("orders", "clicks"), stream="main"):
    """Everything that the topics hold goes to bronze."""
    running = ingest.start_bronze(
        spark, root, topics, "parquet", ingest.ALL_AVAILABLE, stream=stream, path=root + "/topics/{topic}", maxFilesPerTrigger=4
    )
    for query in running:
        query.awaitTermination()
    return root


def places(bronze, *more):
    return shown(bronze.select("topic", "partition", "offset", "kafka_timestamp", *more))


def stream_scan(spark, sf):
    """Records read as a stream, written by Spark's own file sink and read back."""
    root = stored_topics(spark, sf, ["clicks"])
    stream = ingest.read_events(spark, "clicks", "parquet", path=f"{root}/topics/clicks", maxFilesPerTrigger=4)
    query = (
        events.to_bronze(stream).writeStream.format("parquet").option("path", f"{root}/copy")
        .option("checkpointLocation", f"{root}/copy_checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return places(spark.read.parquet(f"{root}/copy"))


def bronze_append(spark, sf):
    root = stream_topics(spark, stored_topics(spark, sf, ["clicks"]), ["clicks"])
    bronze = tables.read_table(spark, root, "bronze", "clicks")
    return places(bronze, "kafka_key", F.sha2("raw_value", 256).alias("payload_sha256"))


def stream_two_topics(spark, sf):
    root = stream_topics(spark, stored_topics(spark, sf))
    both = tables.read_table(spark, root, "bronze", "orders").unionByName(
        tables.read_table(spark, root, "bronze", "clicks")
    )
    return both.groupBy("topic", F.col("partition").alias("part_no")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def stream_resume(spark, sf):
    """The stream is stopped and started again on its checkpoint: nothing is read twice."""
    root = stream_topics(spark, stored_topics(spark, sf, ["clicks"]), ["clicks"])
    stream_topics(spark, root, ["clicks"])
    return tables.read_table(spark, root, "bronze", "clicks").groupBy(
        F.col("partition").alias("part_no")
    ).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("offset").alias("offsets"))


def stream_replay_dedup(spark, sf):
    """The whole topic is delivered twice (a new checkpoint); silver shows each click once."""
    root = stream_topics(spark, stored_topics(spark, sf, ["clicks"]), ["clicks"])
    stream_topics(spark, root, ["clicks"], "second")
    return shown(silver.silver_clicks(tables.read_table(spark, root, "bronze", "clicks"))).drop("timestamp")


def table_scan(spark, sf):
    root = place(spark, "scan")
    tables.write_snapshot(orders(spark, sf), root, "silver", "orders")
    back = tables.read_table(spark, root, "silver", "orders")
    return shown(back.select("order_id", "user_id", "status", "total_amount", "event_ts"))


def silver_incremental(spark, sf):
    """The click topic arrives in two parts; the second refresh reads only the second part."""
    root = place(spark, "layers")
    for part in topic_parts(spark, sf, "clicks"):
        part.write.mode("append").parquet(f"{root}/topics/clicks")
        stream_topics(spark, root, ["clicks"])
        extend_silver(spark, root)
    return shown(tables.read_table(spark, root, "silver", "clicks")).drop("timestamp")


def topic_parts(spark, sf, name):
    """A topic in two parts; of an id with copies, the first one is in the first part, or all are in one."""
    if name == "clicks":  # an event with an even number comes first, its replay (odd offset) in the second part
        records, late = derived_topics.click_records(spark, sf), F.col("offset") % 2
    else:
        records, late = derived_topics.order_records(spark, sf), (F.col("partition") > 0).cast("int")
    return [records.where(late == part) for part in (0, 1)]


def arrive(spark, root, name, records):
    """One more part of a topic goes to bronze, as one batch."""
    send(root, name, records)
    for query in ingest.start_bronze(spark, root, [name], "parquet", ingest.ALL_AVAILABLE, path=root + "/topics/{topic}"):
        query.awaitTermination()
    expire(spark, root, name)


def two_batches(spark, sf):
    """bronze.clicks in two batches, which are its versions."""
    root = place(spark, "batches")
    for part in topic_parts(spark, sf, "clicks"):
        arrive(spark, root, "clicks", part)
    return root


def version_scan_bronze(spark, sf):
    """The rows of each version, read by its number and by the name of its view."""
    root = two_batches(spark, sf)
    both = None
    for version in (0, 1):
        view = tables.register_table(spark, root, "bronze", "clicks", version)
        rows = tables.read_table(spark, root, "bronze", "clicks", version)
        named = spark.table(view).agg(F.count(F.lit(1))).scalar()
        part = rows.groupBy(F.col("partition").alias("part_no")).agg(
            F.lit(version).cast("bigint").alias("version"), F.count(F.lit(1)).alias("row_count"), named.alias("in_view"),
            F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum(F.col("offset").cast("decimal(20,0)")).cast("bigint").alias("offsets"),
        )
        both = part if both is None else both.unionByName(part)
    return both


def table_history_bronze(spark, sf):
    history = tables.history(spark, two_batches(spark, sf), "bronze", "clicks")
    return history.select(
        "version", "operation", F.col("operation_parameters")["stream"].alias("stream"), F.col("timestamp").isNotNull().alias("dated"),
        F.col("operation_metrics")["numOutputRows"].cast("bigint").alias("row_count"),
        (F.col("operation_metrics")["numFiles"].cast("int") > 0).alias("has_files"),
    )


def stream_row_counts(spark, sf):
    """Rows of both topics: read and written by the stream to bronze, rejected by each rule, copies, written to silver; as the streams observed."""
    root = place(spark, "layers")
    counts = []
    for name in ("orders", "clicks"):
        read = written = 0
        for part in topic_parts(spark, sf, name):
            send(root, name, part)
            for query in ingest.start_bronze(spark, root, [name], "parquet", ingest.ALL_AVAILABLE, path=root + "/topics/{topic}", maxFilesPerTrigger=4):
                query.awaitTermination()
                batches = reports(query)
                read += sum(b.rows_read for b in batches)
                written += sum(b.observed["rows_written"] for b in batches)
            expire(spark, root, name)
        counts.append([name, read, written])
    for row, done in zip(counts, extend_silver(spark, root)):
        row += [done.metrics["rows_read"], done.metrics["no_id"], done.metrics["not_positive"], done.metrics.get("unknown_status", 0), done.metrics["copies"], done.rows]
    return spark.createDataFrame(
        [tuple(row) for row in counts],
        "topic string, bronze_read bigint, bronze_written bigint, silver_read bigint, no_id bigint, not_positive bigint, unknown_status bigint, "
        "copies bigint, silver_written bigint",
    )


def gold_incremental(spark, sf):
    """Both topics arrive in two parts; silver and gold are brought up to date after each from what is new."""
    root = place(spark, "layers")
    for parts in zip(topic_parts(spark, sf, "orders"), topic_parts(spark, sf, "clicks")):
        for name, part in zip(("orders", "clicks"), parts):
            arrive(spark, root, name, part)
        run_once(spark, root, incremental=True)
    return gold_rows(spark, root)


def dated_orders(spark, sf):
    """Silver orders by date: those of one partition of the topic come late."""
    root = place(spark, "dated")
    for late, build in ((False, dated.write_dated_orders), (True, dated.add_late_orders)):
        records = f"{root}/arrived"  # stored, so that the joins that make the topic and the cleaning never have their shuffles at once
        tables.write_files(bronze_orders(spark, sf).where((F.col("partition") == 2) == F.lit(late)), records)
        build(silver.silver_orders(spark.read.parquet(records)), root, MONTH)
        remove(spark, records)
    return root


def revenue_by_date(spark, sf):
    """Daily revenue of some years, from their files alone."""
    return shown(dated.revenue_between(spark, dated_orders(spark, sf), "1996-03-15", "1999-12-31", MONTH))


def latest_days_pruned(spark, sf):
    return shown(dated.latest_revenue(spark, dated_orders(spark, sf)))


def late_dates(spark, sf):
    """Stored daily revenue: of all dates first, then, after late orders, of their dates alone."""
    root = place(spark, "late")
    for late in (False, True):
        clean = silver.silver_orders(bronze_orders(spark, sf).where((F.col("partition") == 2) == F.lit(late)))
        tables.write_snapshot(clean, root, "silver", "orders_arrived")  # read for its rows and, up to three times, for its dates
        new = tables.read_table(spark, root, "silver", "orders_arrived")
        if late:
            dated.add_late_orders(new, root, MONTH, stored=True)
        else:
            dated.write_dated_orders(new, root, MONTH, stored=True)
        dated.refresh_dates(spark, root, new, MONTH)
    return shown(tables.read_table(spark, root, "gold", "daily_revenue_dated").drop("event_date"))


def bronze_compaction(spark, sf):
    """Many small batches, packed, and one more batch: the rows, and whether the files to read are fewer."""
    root = stream_topics(spark, stored_topics(spark, sf, ["clicks"]), ["clicks"])
    layout.compact_bronze(spark, root, "clicks")
    derived_topics.click_records(spark, sf).where(F.col("partition") == 0).coalesce(1).write.mode("append").parquet(f"{root}/topics/clicks")
    stream_topics(spark, root, ["clicks"])
    whole = layout.read_compacted(spark, root, "clicks")
    return whole.groupBy("topic", F.col("partition").alias("part_no")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("offset").alias("offsets"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
    )


def distinct_by_bitmap(spark, sf):
    """Exact distinct counts over all clean orders, in one aggregation of bitmaps over dictionary numbers."""
    root = place(spark, "distinct")
    tables.write_snapshot(orders(spark, sf, "user_id", "product_id"), root, "silver", "orders")
    stored = tables.read_table(spark, root, "silver", "orders").select("user_id", "product_id", F.col("event_ts").cast("string").alias("instant"))
    for column in stored.columns:
        distinct.extend_dictionary(stored.select(column), root, column)
    numbered = distinct.with_ids(stored, {c: c for c in stored.columns}, root)
    measures = {"users": "user_id_id", "products": "product_id_id", "instants": "instant_id"}
    return distinct.distinct_counts(distinct.bitmaps(numbered, [], measures), [], list(measures))


def funnel_by_bitmap(spark, sf):
    """The page funnel from stored bitmaps, to which two parts of the clicks were added one after the other."""
    root = place(spark, "bitmaps")
    tables.write_snapshot(clicks(spark, sf, "user_id", "session_id", "page", "converted"), root, "silver", "clicks")
    stored = tables.read_table(spark, root, "silver", "clicks")
    for part in (0, 1):
        visitors.add_clicks(stored.where(F.crc32("click_id") % 2 == part), root)
    return shown(visitors.funnel(spark, root))


def two_versions(spark, sf):
    """silver.orders as of all completed, then of all refunded orders."""
    root = place(spark, "versions")
    tables.write_snapshot(orders(spark, sf), root, "clean", "orders")
    for status in ("completed", "refunded"):
        chosen = tables.read_table(spark, root, "clean", "orders").where(F.col("status") == status)
        tables.write_snapshot(chosen, root, "silver", "orders")
    return root


def version_scan(spark, sf):
    root = two_versions(spark, sf)
    both = None
    for version in (0, 1):
        part = tables.read_table(spark, root, "silver", "orders", version).agg(
            F.lit(version).cast("bigint").alias("version"), F.count(F.lit(1)).alias("row_count"),
            money.exact_sum(F.col("total_amount")).alias("revenue"),
        )
        both = part if both is None else both.union(part)
    return both


def table_history(spark, sf):
    history = tables.history(spark, two_versions(spark, sf), "silver", "orders")
    return history.select(
        "version", F.col("timestamp").isNotNull().alias("dated"), "operation", F.col("operation_parameters")["mode"].alias("mode"), "row_count"
    )


def optional_scan(spark, sf):
    """No click table was ever written: the user measures do without it."""
    root = place(spark, "optional")
    tables.write_snapshot(orders(spark, sf), root, "silver", "orders")
    return shown(gold.user_metrics(
        tables.try_read_table(spark, root, "silver", "orders"),
        tables.try_read_table(spark, root, "silver", "clicks"),
    ))


def named_table_sql(spark, sf):
    root = place(spark, "named")
    tables.write_snapshot(pages(spark, sf), root, "gold", "funnel")
    tables.register_layers(spark, root)
    return spark.sql("SELECT page, visits, conversion_rate FROM gold.funnel WHERE visits > 0")


def snapshot_overwrite(spark, sf):
    """A second write replaces rows and schema."""
    root = place(spark, "overwrite")
    wanted = orders(spark, sf, "user_id").select("order_id", "user_id", "status", "total_amount")
    tables.write_snapshot(wanted, root, "clean", "orders")  # both writes read it: the orders are cleaned once
    all_orders = tables.read_table(spark, root, "clean", "orders")
    tables.write_snapshot(all_orders.select("order_id", "status"), root, "silver", "orders")
    tables.write_snapshot(
        silver.completed(all_orders).select("order_id", "user_id", "total_amount"), root, "silver", "orders"
    )
    return tables.read_table(spark, root, "silver", "orders")


def commit_rows(spark, done):
    """What was committed: at most one row per layer table."""
    return spark.createDataFrame(
        [(c.layer, c.table, c.version, c.rows) for c in done],
        "layer string, table_name string, version bigint, row_count bigint",
    )


def write_row_count(spark, sf):
    root = place(spark, "count")
    return commit_rows(spark, [tables.write_snapshot(orders(spark, sf), root, "silver", "orders")])


def gold_refresh_tables(spark, sf):
    root = place(spark, "gold")
    tables.write_snapshot(orders(spark, sf), root, "silver", "orders")
    tables.write_snapshot(clicks(spark, sf), root, "silver", "clicks")
    refresh_gold(spark, root)
    return root


def gold_refresh(spark, sf):
    """All rows of all four tables, each as one text."""
    return gold_rows(spark, gold_refresh_tables(spark, sf))


def gold_rows(spark, root):
    result = None
    for name in tables.LAYERS["gold"]:
        rows = shown(tables.read_table(spark, root, "gold", name))
        texts = [
            F.when(F.col(c).isNull(), "-").otherwise(F.format_string("%.4f", c) if t == "double" else F.col(c).cast("string"))
            for c, t in rows.dtypes
        ]
        part = rows.select(F.lit(name).alias("table_name"), F.concat_ws("|", *texts).alias("line"))
        result = part if result is None else result.union(part)
    return result


def refresh_all(spark, sf):
    root = place(spark, "layers")
    for name, records in (("orders", derived_topics.order_records), ("clicks", derived_topics.click_records)):
        send(root, name, records(spark, sf))
        stream_topics(spark, root, [name])
        expire(spark, root, name)
    return commit_rows(spark, run_once(spark, root))


# Models. What the fitted models give is stated so that SQL can check it.

_modelled = {}


def modelled(spark, sf):
    """All three models and the results of the best one, fitted once for a session and the files of the tables."""
    key = (spark.sparkContext.applicationId, sf, tuple(matching(spark, f"{sf}/*.parquet")))
    if key not in _modelled:
        _modelled[key] = propensity(stored_users(spark, sf)[1], place(spark, "models"), THRESHOLD)
    return _modelled[key]


def fitted(spark, sf, name):
    """One model, as (model, AUC), and its inputs."""
    return propensity(stored_users(spark, sf)[1], place(spark, "models"), THRESHOLD, [name])


def logistic_regression(spark, sf):
    """The gradient of the objective (log-loss and half the squared weights) at the fitted weights, by weight."""
    found = fitted(spark, sf, models.LOGISTIC)
    return rounded(models.logistic_gradient(found.best.model, found.inputs.where("not is_test")), 0, "gradient")


def tree_model(name):
    """Features by whether their importance is a share, the sum of the shares, and an AUC above 0.8."""
    def query(spark, sf):
        found = fitted(spark, sf, name)
        total = found.importances.agg(F.round(F.sum("importance"), 9)).scalar()
        return found.importances.select(
            F.lit(name).alias("model"), "feature", F.col("importance").between(0, 1).alias("is_share"),
            total.alias("total"), F.lit(found.best.auc > 0.8).alias("learns"),
        )
    return query


def tree_walk(spark, stored, name):
    """One tree model of stored users, its stored nodes, and whether it is a boosted one."""
    root = place(spark, "trees")
    found = propensity(stored, root, THRESHOLD, [name])
    trees.node_table(spark, found.best.model, f"{root}/model").write.parquet(f"{root}/nodes")
    return found, spark.read.parquet(f"{root}/nodes"), name == models.BOOSTING


def tree_scores(spark, sf):
    """Every user by model: whether the score from the stored nodes is the model's, and the class and segment those of the score."""
    result, stored = None, stored_users(spark, sf)[1]
    for name in (models.FOREST, models.BOOSTING):
        found, nodes, boosted = tree_walk(spark, stored, name)
        inputs = found.inputs.select("user_id", vector_to_array("raw").alias("x"))
        walked = trees.walk(inputs, "user_id", "x", nodes, boosted, trees.depth_of(nodes))
        of_model = models.score(found.best.model, found.inputs).join(found.scored.select("user_id", "segment"), "user_id")
        part = of_model.join(walked, "user_id").select(
            F.lit(name).alias("model"), "user_id", (F.abs(F.col("score") - F.col("propensity_score")) < 1e-9).alias("is_same"),
            (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("is_likelier"),
            F.col("segment").eqNullSafe(scalars.segment(F.col("propensity_score"))).alias("is_binned"),
        )
        result = part if result is None else result.unionAll(part)
    return result


def tree_importances(spark, sf):
    """Features by model: whether the importance from the nodes' gains is the model's, in the same order."""
    result, stored = None, stored_users(spark, sf)[1]
    order = Window.partitionBy("model").orderBy
    for name in (models.FOREST, models.BOOSTING):
        found, nodes, boosted = tree_walk(spark, stored, name)
        own = trees.importance_table(nodes, FEATURES, boosted).select(F.lit(name).alias("model"), "feature", F.col("importance").alias("own"))
        both = own.join(found.importances, "feature")
        part = both.select(
            "model", "feature", (F.abs(F.col("own") - F.col("importance")) < 1e-9).alias("is_same"),
            (F.row_number().over(order(F.round("own", 9), "feature")) == F.row_number().over(order(F.round("importance", 9), "feature"))).alias("same_place"),
        )
        result = part if result is None else result.unionAll(part)
    return result


def best_model(spark, sf):
    """Models, by whether their AUC is a valid one and the best one has the highest."""
    found = modelled(spark, sf)
    return spark.createDataFrame(
        [(r.name, 0.5 < r.auc <= 1, found.best.auc >= r.auc) for r in found.results],
        "model string, learns boolean, best_is_no_worse boolean",
    )


def predict_proba(spark, sf):
    """Test users, by whether their score is a probability, and equal to that among all users."""
    found = modelled(spark, sf)
    every = found.scored.select("user_id", F.col("propensity_score").alias("other"))
    return found.tested.join(every, "user_id").select(
        "user_id", F.col("propensity_score").between(0, 1).alias("is_probability"),
        (F.col("propensity_score") == F.col("other")).alias("is_same"),
    )


def predict_class(spark, sf):
    """Test users, by whether the class is that of the larger probability."""
    larger = (F.col("propensity_score") > 0.5).cast("int")
    return modelled(spark, sf).tested.select("user_id", LABEL, (F.col("prediction") == larger).alias("is_likelier"))


def score_all_users(spark, sf):
    """All users, by whether the segment is that of the score's bin."""
    score = F.col("propensity_score")
    own = F.when(score > 0.66, "high").when(score > 0.33, "medium").when(score > 0, "low")
    return modelled(spark, sf).scored.select("user_id", F.col("segment").eqNullSafe(own).alias("is_binned"))


def top_propensity(spark, sf):
    """The ten users, ranked, by how many users outside have a higher score."""
    found = modelled(spark, sf)
    top = models.top_propensity(found.scored)
    least = top.agg(F.min("propensity_score")).scalar()
    above = found.scored.join(top.select("user_id"), "user_id", "left_anti").where(F.col("propensity_score") > least)
    outside = above.agg(F.count(F.lit(1))).scalar()
    order = Window.orderBy(F.desc("propensity_score"), "user_id")
    return top.select(F.row_number().over(order).alias("place"), outside.alias("higher_outside"))


def feature_importance(spark, sf):
    return modelled(spark, sf).importances.select("feature", (~F.isnan("importance")).alias("is_number"))


def propensity_results(spark, sf):
    """Every result of the job with its number of rows, and of users behind them."""
    found = modelled(spark, sf)
    sizes = {
        "scored": (found.scored, F.count(F.lit(1))), "tested": (found.tested, F.count(F.lit(1))),
        "report": (found.report.where("class = 'accuracy'"), F.sum("support")), "matrix": (found.matrix, F.sum("rows")),
        "importances": (found.importances, F.lit(0).cast("bigint")),
        "segments": (found.segments.unionAll(found.scored.where("segment is null").agg(F.lit("none"), F.count(F.lit(1)))), F.sum("users")),
        "histogram": (found.histogram, F.sum("rows")),
    }
    result = None
    for name, (rows, users_behind) in sizes.items():
        part = rows.agg(F.lit(name).alias("result"), users_behind.alias("users"))
        result = part if result is None else result.union(part)
    return result


def part():
    return F.col("partition").alias("part_no")


def off():
    return F.col("offset").alias("off_no")


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def scaled(spark, sf):
    rows = split(spark, sf)
    fitted_on = features.fit_scaler(rows.where(~F.col("is_test")))
    names = [f"scaled_{c}" for c in FEATURES]
    return rounded(features.scale(rows, fitted_on).select("user_id", "is_test", *names), 6, *names)


def feature_summary(spark, sf):
    summary = features.summarize(features.user_features(stored_users(spark, sf)[1], THRESHOLD), FEATURES)
    return rounded(summary, 6, "mean", "std", "q25", "q50", "q75")


def exact_auc(spark, sf):
    auc = evaluate.roc_auc(pseudo_scored(spark, sf), "score")
    return spark.createDataFrame([(round(auc, 9),)], "auc double")


def entry(spark: SparkSession) -> DataFrame:
    """Daily revenue from the raw order topic."""
    return shown(daily(spark, SMALLEST)).orderBy("date")


def queries() -> dict[str, Query]:
    """One entry per operator; each takes (spark, sf_dir)."""
    both_events = lambda s, d: derived_topics.order_events(s, d).unionByName(
        derived_topics.click_events(s, d), allowMissingColumns=True)
    text = lambda c: F.col(c).cast("string").alias(f"{c}_text")
    return {
        # sources
        "stream_scan": stream_scan,
        "table_scan": table_scan,
        "optional_scan": optional_scan,
        "version_scan": version_scan,
        "table_history": table_history,
        "version_scan_bronze": version_scan_bronze,
        "table_history_bronze": table_history_bronze,
        "named_table_sql": named_table_sql,
        "describe_schema": lambda s, d: explore.schema_rows(stored_users(s, d)[1]),
        # sinks and encoding
        "bronze_append": bronze_append,
        "snapshot_overwrite": snapshot_overwrite,
        "write_row_count": write_row_count,
        "stream_row_counts": stream_row_counts,
        "bronze_compaction": bronze_compaction,
        "late_dates": late_dates,
        "event_encode": lambda s, d: events.encode_events(
            derived_topics.click_events(s, d), "click_id", "clicks", CLICK_PAYLOAD
        ).select(text("key"), text("value"), "topic", part(), off()),
        "topic_route": lambda s, d: events.route_events(both_events(s, d)).select(
            "topic", text("key"), F.get_json_object(F.col("value").cast("string"), "$.event_type").alias("event_type")),
        # projections and filters
        "envelope_project": lambda s, d: shown(
            bronze_orders(s, d).unionByName(bronze_clicks(s, d)).drop("raw_value")),
        "json_parse_flatten": lambda s, d: shown(parsed_orders(s, d).drop("timestamp", "kafka_key")),
        "filter_not_null": lambda s, d: parsed_orders(s, d).where(silver.has_id("order_id")).select(part(), off(), "order_id"),
        "filter_positive": lambda s, d: parsed_clicks(s, d).where(silver.positive("duration_ms")).select(part(), off(), "duration_ms"),
        "filter_positive_amount": lambda s, d: parsed_orders(s, d).where(silver.positive("total_amount")).select(
            part(), off(), "total_amount"),
        "filter_in_list": lambda s, d: parsed_orders(s, d).where(
            silver.known_status()).select(part(), off(), "status"),
        "filter_equals": lambda s, d: silver.completed(orders(s, d)).select("order_id", "status", "total_amount"),
        "derive_columns": lambda s, d: shown(
            parsed_clicks(s, d).where("event_type is not null").withColumns({
                "event_ts": scalars.parse_instant(F.col("timestamp")),
                "referrer": silver.visit_referrer(),
            }).select("offset", "partition", "click_id", "event_ts", "referrer")),
        "select_columns": lambda s, d: clicks(s, d).select("click_id", "user_id", "page", "duration_ms"),
        # joins
        "user_left_join": lambda s, d: users(s, d).select(
            "user_id", "completed_orders", "total_clicks", "converted_clicks", "total_sessions"),
        "user_metrics_no_clicks": lambda s, d: shown(gold.user_metrics(orders(s, d), None)),
        # aggregations
        "dedup_orders": lambda s, d: silver.first_copy(
            silver.valid_orders(parsed_orders(s, d)), ["order_id"]
        ).select("order_id", part(), off(), F.round("total_amount", 2).alias("total_amount")),
        "dedup_clicks": lambda s, d: silver.first_copy(
            silver.valid_clicks(parsed_clicks(s, d)), ["click_id"]
        ).select("click_id", part(), off(), "duration_ms"),
        "daily_revenue": lambda s, d: shown(daily(s, d)),
        "product_metrics": lambda s, d: shown(products(s, d)),
        "user_orders": lambda s, d: shown(gold.user_orders(buyers(s, d))),
        "user_clicks": lambda s, d: gold.user_clicks(clicks(s, d, "user_id", "session_id", "converted")),
        "user_metrics": lambda s, d: shown(users(s, d)),
        "funnel": lambda s, d: shown(pages(s, d)),
        "status_distribution": lambda s, d: explore.status_distribution(orders(s, d)),
        "category_revenue": lambda s, d: explore.category_revenue(orders(s, d)),
        "row_count": lambda s, d: explore.row_count(orders(s, d)),
        "agg_count_distinct": lambda s, d: orders(s, d).agg(
            F.count_distinct("user_id").alias("users"), F.count_distinct("product_id").alias("products"),
            F.count_distinct("event_ts").alias("instants")),
        "distinct_by_bitmap": distinct_by_bitmap,
        "funnel_by_bitmap": funnel_by_bitmap,
        "agg_conditional": lambda s, d: orders(s, d).groupBy("category").agg(
            F.count(F.when(F.col("status") == "completed", 1)).alias("completed"),
            F.count(F.when(F.col("status") == "cancelled", 1)).alias("cancelled"),
            money.exact_sum(F.when(F.col("status") == "completed", F.col("total_amount"))).alias("spend"),
            money.exact_mean(F.when(F.col("status") == "completed", F.col("total_amount"))).alias("mean_spend")),
        "agg_min_max_ts": lambda s, d: shown(orders(s, d).groupBy("user_id").agg(
            F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))),
        "feature_summary": feature_summary,
        # sorts and top-k
        "latest_days_top10": lambda s, d: shown(explore.latest_days(daily(s, d))),
        "latest_days_pruned": latest_days_pruned,
        "revenue_by_date": revenue_by_date,
        "top_products": lambda s, d: shown(explore.top_products(products(s, d))),
        "top_users": lambda s, d: shown(explore.top_users(users(s, d))),
        "funnel_by_visits": lambda s, d: shown(explore.funnel_by_visits(pages(s, d))),
        "revenue_series": lambda s, d: shown(explore.revenue_series(daily(s, d))),
        "limit_n": lambda s, d: explore.first_rows(
            orders(s, d).select("order_id", "user_id", "status", "total_amount"), ["order_id"], 5),
        "top_propensity": top_propensity,
        # scalar functions
        "scalar_json_parse": lambda s, d: parsed_clicks(s, d).select(off(), "duration_ms", "converted", "page"),
        "scalar_to_timestamp": lambda s, d: parsed_orders(s, d).select(
            off(), scalars.parse_instant(F.col("timestamp")).cast("timestamp_ntz").alias("event_ts")),
        "scalar_day_trunc": lambda s, d: derived_topics.click_events(s, d).select(
            off(), scalars.day(F.col("record_ts")).cast("timestamp_ntz").alias("day")),
        "scalar_round": lambda s, d: derived_topics.order_events(s, d).select(
            off(), scalars.cents(F.col("total_amount")).alias("amount"),
            F.round(F.col("quantity") / (F.col("partition") + 1), 4).alias("ratio")),
        "scalar_case": lambda s, d: orders(s, d).select(
            "order_id", F.when(F.col("status") == "completed", 1).otherwise(0).alias("is_completed"),
            F.when(F.col("status") == "completed", F.col("total_amount")).alias("spent")),
        "scalar_coalesce": lambda s, d: derived_topics.click_events(s, d).select(
            off(), silver.visit_referrer().alias("referrer")),
        "scalar_fillna": lambda s, d: shown(users(s, d).fillna(0).select(
            "user_id", "last_order_ts", "total_clicks", "total_spend", "conversion_rate")),
        "scalar_cast": lambda s, d: users(s, d).select(
            "user_id", F.col("total_orders").try_cast("int").alias("total_orders"),
            F.col("total_clicks").try_cast("int").alias("total_clicks"),
            F.col("unique_products_bought").cast("double").alias("products"),
            F.col("completed_orders").cast("string").alias("completed_text")),
        "scalar_ratio": lambda s, d: users(s, d).select(
            "user_id", scalars.rate(F.col("completed_orders"), F.col("total_clicks")).alias("ratio")),
        "scalar_predicates": lambda s, d: derived_topics.click_events(s, d).select(
            off(), F.col("click_id").isNull().alias("no_id"), (F.col("duration_ms") > 0).alias("positive"),
            (F.col("referrer") == "search").alias("from_search"),
            F.col("referrer").isin("mailing", "direct").alias("own"), F.col("referrer").isNotNull().alias("known")),
        "scalar_json_encode": lambda s, d: derived_topics.click_events(s, d).select(
            off(), events.to_payload(events.payload_fields(CLICK_PAYLOAD)).alias("payload")),
        "scalar_iso_format": lambda s, d: derived_topics.click_events(s, d).select(
            off(), scalars.iso_instant(F.col("record_ts")).alias("text")),
        "scalar_padded_id": lambda s, d: derived_topics.load(s, d, "lineitem").select(
            "l_orderkey", "l_linenumber", scalars.padded_id("P", F.col("l_partkey"), 4).alias("product_id"),
            scalars.padded_id("U", F.col("l_suppkey"), 5).alias("user_id")),
        "scalar_segment": lambda s, d: pseudo_scored(s, d).select(
            "user_id", "score", scalars.segment(F.col("score")).alias("segment")),
        # features, models, evaluation
        "user_features": user_features,
        "class_balance": lambda s, d: rounded(features.class_balance(user_features(s, d)), 9, "positive_share"),
        "stratified_split": lambda s, d: split(s, d).select("user_id", LABEL, "is_test"),
        "split_sizes": lambda s, d: features.split_sizes(split(s, d)),
        "standard_scale": scaled,
        "logistic_regression": logistic_regression,
        "random_forest": tree_model(models.FOREST),
        "gradient_boosting": tree_model(models.BOOSTING),
        "roc_auc": exact_auc,
        "predict_proba": predict_proba,
        "tree_scores": tree_scores,
        "tree_importances": tree_importances,
        "best_model": best_model,
        "predict_class": predict_class,
        "classification_report": lambda s, d: rounded(
            evaluate.classification_report(pseudo_scored(s, d)), 9, "precision", "recall", "f1_score"),
        "confusion_matrix": lambda s, d: evaluate.confusion_matrix(pseudo_scored(s, d)),
        "feature_importance": feature_importance,
        "score_all_users": score_all_users,
        "segment_distribution": lambda s, d: evaluate.segment_distribution(pseudo_scored(s, d), "score"),
        "score_histogram": lambda s, d: evaluate.histogram(
            pseudo_scored(s, d, stored_users(s, d)[1]), "score"),
        # streaming
        "stream_two_topics": stream_two_topics,
        "stream_resume": stream_resume,
        "stream_replay_dedup": stream_replay_dedup,
        # jobs
        "silver_orders": lambda s, d: shown(orders(s, d).withColumnRenamed("timestamp", "ts_text")),
        "silver_clicks": lambda s, d: shown(clicks(s, d).withColumnRenamed("timestamp", "ts_text")),
        "silver_incremental": silver_incremental,
        "gold_refresh": gold_refresh,
        "gold_incremental": gold_incremental,
        "run_once": refresh_all,
        "propensity": propensity_results,
    } | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    """DuckDB statements by query key; the others are checked for rows only."""
    return oracle.statements() | (llm.oracle_sql() if llm else {})
