"""Writers, model persistence, empty inputs, missing feature columns."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL
from voxlens.config import ACCOUNT_FEATURE_COLS
from voxlens.operators import features as feat
from voxlens.operators import learn, scoring, sinks
from voxlens.sources.tables import Tables


def test_snapshot_and_append_writers(spark):
    base = tempfile.mkdtemp(prefix="voxlens-io-")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    p = sinks.write_snapshot(df, base, "scores", "2024-01-31")
    assert sorted(sinks.read_snapshot(spark, base, "scores", "2024-01-31").collect()) == sorted(df.collect())
    assert p.endswith("scores/snapshot=2024-01-31")
    sinks.append_log(df, base, "log")
    sinks.append_log(df, base, "log")
    assert spark.read.parquet(os.path.join(base, "log")).count() == 4


def test_model_save_load_round_trip(spark):
    t = Tables(spark, SMALL)
    feats = feat.account_features(t.feedback, grain="user")
    scaled = scoring.standardize(feat.feature_matrix(feats))
    labels = learn.stratified_split(learn.synthetic_labels(feats)).select("account_id", "churned", "is_test")
    data = scaled.join(labels, "account_id")
    model = learn.fit_churn_classifier(data.where(~F.col("is_test")))
    path = learn.save_model(model, os.path.join(tempfile.mkdtemp(prefix="voxlens-model-"), "churn"))
    again = learn.load_model(path)
    a = {r.account_id: r.churn_probability for r in learn.predict_churn(model, data).collect()}
    b = {r.account_id: r.churn_probability for r in learn.predict_churn(again, data).collect()}
    assert a == b and len(a) == data.count()
    assert all(0.0 <= p <= 1.0 for p in a.values())


def test_empty_feedback_gives_empty_outputs(spark):
    t = Tables(spark, SMALL)
    empty = t.feedback.where(F.lit(False))
    assert scoring.product_area_impact(empty).count() == 0
    assert scoring.account_risk_scores(empty).count() == 0
    assert feat.area_features(empty).count() == 0


def test_feature_matrix_skips_missing_columns(spark):
    df = spark.createDataFrame([("a", 3, None)], "account_id string, total_feedback long, negative_ratio double")
    m = feat.feature_matrix(df)
    present = [c for c in ACCOUNT_FEATURE_COLS if c in ("total_feedback", "negative_ratio")]
    assert m.columns == ["account_id", *present]
    assert m.first().negative_ratio == 0.0


def test_date_partitioned_facts_prune_and_match(spark):
    t = Tables(spark, SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="voxlens-facts-"), "feedback")
    sinks.write_feedback(t.feedback, path)
    stored = spark.read.parquet(path)
    filtered = feat.lookback(stored)
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan and "created_date#" in plan
    a = feat.area_features(stored).drop("created_date")
    b = feat.area_features(t.feedback)
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_mlp_variant_fits_and_predicts(spark):
    t = Tables(spark, SMALL)
    feats = feat.account_features(t.feedback, grain="user")
    scaled = scoring.standardize(feat.feature_matrix(feats))
    labels = learn.synthetic_labels(feats).select("account_id", "churned")
    data = scaled.join(labels, "account_id")
    model = learn.fit_churn_classifier(data, kind="mlp")
    preds = learn.predict_churn(model, data).collect()
    assert len(preds) == data.count()
    assert all(0.0 <= r.churn_probability <= 1.0 for r in preds)
