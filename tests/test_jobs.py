from helpers import click, order, records
from strata.__main__ import main
from strata.sources import tables
from strata.streaming import ingest


def fill(spark, root, batch):
    rows = {
        "orders": [order(f"o{batch}-{i}", user_id=f"U{i}", total_amount=10.0 * i + 1) for i in range(20)],
        "clicks": [click(f"c{batch}-{i}", user_id=f"U{i % 7}") for i in range(20)],
    }
    for topic, payloads in rows.items():
        records(spark, payloads, topic, 100 * batch).write.mode("append").parquet(f"{root}/topics/{topic}")
        source = ingest.read_events(spark, topic, "parquet", path=f"{root}/topics/{topic}")
        ingest.write_bronze(source, root, topic, ingest.ALL_AVAILABLE).awaitTermination()


def test_refresh_job(spark, root, capsys):
    fill(spark, root, 0)
    main(["refresh", "--root", root])
    assert "silver.orders version 0: 20 rows" in capsys.readouterr().out
    assert spark.sql("SELECT count(*) FROM gold.user_metrics").first()[0] == 20
    fill(spark, root, 1)
    # After a full refresh a new table is filled from all of bronze; the next call adds what is new.
    main(["refresh", "--root", root, "--incremental"])
    assert "silver.orders version 1: 40 rows" in capsys.readouterr().out
    fill(spark, root, 2)
    main(["refresh", "--root", root, "--incremental"])
    assert "silver.orders version 1: 20 rows" in capsys.readouterr().out
    assert tables.read_table(spark, root, "silver", "orders").count() == 60
    assert tables.read_table(spark, root, "gold", "user_metrics").agg({"total_orders": "sum"}).first()[0] == 60


def test_score_job(spark, root, capsys, monkeypatch):
    import strata.__main__ as jobs
    from strata.plans.propensity import propensity_of

    def small(session, where, threshold):
        return propensity_of(session, where, threshold, trees=3, rounds=2, depth=3)

    monkeypatch.setattr(jobs, "propensity_of", small)
    fill(spark, root, 0)
    main(["refresh", "--root", root])
    main(["score", "--root", root, "--threshold", "100"])
    out = capsys.readouterr().out
    assert "Logistic Regression: AUC" in out and "propensity_score" in out and "weighted avg" in out
    assert tables.read_table(spark, root, "ml", "scored_users").count() == 20
    assert not tables.matching(spark, f"{root}/ml/strata-*")
