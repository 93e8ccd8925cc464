"""End-to-end jobs: publish, upsert over the previous snapshot, log, status."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from voxlens.operators import artifacts, scoring
from voxlens.plans import jobs
from voxlens.sources.tables import Tables

LARGE = "/root/testdata/sf0.1"  # enough accounts for the fitted model to beat chance


def test_score_jobs_upsert_over_previous_snapshot(spark):
    out = tempfile.mkdtemp(prefix="voxlens-jobs-")
    first = "2024-01-01 00:00:00"
    jobs.score_accounts(spark, SMALL, out, as_of=first, model_version="v0")
    jobs.score_areas(spark, SMALL, out, as_of=first, model_version="v0")
    prev = jobs._snapshot_id(first)
    path = jobs.score_accounts(spark, SMALL, out, previous=prev)
    jobs.score_areas(spark, SMALL, out, previous=prev)
    now = jobs._snapshot_id(None)
    accounts = spark.read.parquet(path)
    assert accounts.count() == accounts.select("account_id").distinct().count()
    assert accounts.where(F.col("model_version") == "v1").count() > 0
    st = {r.table_name: r.row_count for r in jobs.status(spark, SMALL, out, now).collect()}
    assert st["account_risk_scores"] == accounts.count() and st["product_area_impact"] > 0


def test_retrain_check_appends_log(spark):
    out = tempfile.mkdtemp(prefix="voxlens-log-")
    d1 = jobs.retrain_check(spark, SMALL, out).count()
    jobs.retrain_check(spark, SMALL, out)
    assert spark.read.parquet(f"{out}/data_freshness_log").count() == 2 * d1


def test_train_deploy_then_score_with_the_stored_model(spark):
    out = tempfile.mkdtemp(prefix="voxlens-train-")
    run = jobs.train_churn(spark, LARGE, out, test_size=0.2)
    assert run["version"] == "v1" and run["status"] == "completed" and run["promoted"]
    metrics = {r.metric_name: r.metric_value for r in spark.read.parquet(f"{out}/model_metrics").collect()}
    assert metrics["auc"] > 0.5 and all(0 <= v <= 1 for v in metrics.values())
    assert spark.read.parquet(f"{out}/prediction_distribution_history").count() == 2
    assert [r.status for r in jobs.version_status(spark, out).collect()] == ["active"]
    assert jobs.train_churn(spark, LARGE, out) is None  # nothing new since
    again = jobs.train_churn(spark, LARGE, out, force=True, as_of="2024-02-01 00:00:00")
    assert again["version"] == "v2" and again["status"] == "completed"
    assert spark.read.parquet(f"{out}/model_comparisons").count() == 1
    assert spark.read.parquet(f"{out}/training_runs").count() == 2
    path = jobs.score_accounts(spark, LARGE, out, model_version="v1", model_path=run["path"])
    scores = {r.account_id: r.churn_probability for r in spark.read.parquet(path).collect()}
    assert scores and all(0 <= p <= 1 for p in scores.values())
    one = sorted(scores)[3]
    alone = scoring.account_risk_scores(
        Tables(spark, LARGE).feedback, account_id=one, scaler=artifacts.load_scaler(spark, run["path"]),
        codes=artifacts.load_codes(spark, run["path"]), model=artifacts.load_pipeline(spark, run["path"])).collect()
    assert len(alone) == 1 and abs(alone[0].churn_probability - scores[one]) < 1e-9
    missing = jobs.score_accounts(spark, LARGE, out + "-none", model_path=out + "/no-such-model")
    assert spark.read.parquet(missing).count() == len(scores)  # defaults


def test_area_training_stores_weights(spark):
    out = tempfile.mkdtemp(prefix="voxlens-area-")
    overrides = spark.createDataFrame([("negative_sentiment", 0.5), ("unknown", 9.0)], "name string, weight double")
    run = jobs.train_areas(spark, SMALL, out, overrides=overrides)
    stored = {r.name: r.weight for r in artifacts.load_weights(spark, run["path"]).collect()}
    default = {r.name: r.weight for r in artifacts.load_weights(spark, out + "/none").collect()}
    assert stored["negative_sentiment"] == 0.5 and "unknown" not in stored
    assert {k: v for k, v in stored.items() if k != "negative_sentiment"} == {
        k: v for k, v in default.items() if k != "negative_sentiment"}
    path = jobs.score_areas(spark, SMALL, out, model_path=run["path"])
    assert spark.read.parquet(path).count() > 0
    assert [r.status for r in jobs.version_status(spark, out).collect()] == ["active"]
