"""Jobs for spark-submit: `ingest`, `refresh` and `score`, over the layers under --root."""

import argparse

from pyspark.sql import SparkSession

from strata.operators.models import top_propensity
from strata.plans.propensity import propensity_of
from strata.plans.run import run_once
from strata.sources.tables import read_table, register_layers
from strata.streaming.ingest import start_bronze


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest", help="append both topics to bronze until one stream stops")
    ingest.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    refresh = jobs.add_parser("refresh", help="bronze to silver to gold, once")
    refresh.add_argument("--incremental", action="store_true", help="clean and aggregate only what is new")
    score = jobs.add_parser("score", help="fit the propensity models, store scores and evaluation in layer ml")
    score.add_argument("--threshold", type=float, default=200.0)
    for job in (ingest, refresh, score):
        job.add_argument("--root", required=True, help="folder of the layers")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"strata-{options.job}").getOrCreate()
    if options.job == "ingest":
        start_bronze(spark, options.root, servers=options.servers)
        spark.streams.awaitAnyTermination()
    elif options.job == "refresh":
        for done in run_once(spark, options.root, incremental=options.incremental):
            counts = "".join(f", {name} {n}" for name, n in done.metrics.items()) if done.layer == "silver" else ""
            print(f"{done.layer}.{done.table} version {done.version}: {done.rows} rows{counts}")
        register_layers(spark, options.root)
    else:
        for result in propensity_of(spark, options.root, options.threshold):
            print(f"{result.name}: AUC {result.auc:.4f}")
        stored = lambda name: read_table(spark, options.root, "ml", name)
        for name in ("classification_report", "confusion_matrix", "feature_importance", "segment_distribution"):
            stored(name).show()
        top_propensity(stored("scored_users")).show()


if __name__ == "__main__":
    main()
