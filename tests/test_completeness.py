"""Faults that lose or invent rows: stale listings, NULL keys, swallowed errors, capped histories."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from voxlens.operators import id_index, learn, monitor, registry, sinks
from voxlens.sources.tables import Tables
from voxlens.streaming import ingest


def test_a_new_handle_sees_appended_files(spark):
    root = tempfile.mkdtemp(prefix="voxlens-append-")
    rows = spark.range(10).selectExpr("id AS event_id")
    rows.write.parquet(f"{root}/events.parquet")
    assert Tables(spark, root).events.count() == 10
    rows.write.mode("append").parquet(f"{root}/events.parquet")
    assert Tables(spark, root).events.count() == 20


def test_rows_with_a_null_key_stay_in_the_split(spark):
    labels = spark.range(40).select(F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("account_id"),
                                    (F.col("id") % 2).cast("int").alias("churned"))
    for split in (learn.stratified_split(labels), learn.stratified_split_exact(labels)):
        assert split.count() == 40 and split.where("is_test IS NULL").count() == 0
    exact = learn.stratified_split_exact(labels, 0.25).groupBy("churned").agg(F.count_if("is_test").alias("n")).collect()
    assert {r.n for r in exact} == {5}


def test_the_ingest_raises_what_is_not_a_missing_table(spark, monkeypatch):
    ids = spark.createDataFrame([("a",)], "id string")
    missing = tempfile.mkdtemp() + "/none"
    assert id_index.candidate_files(ids, missing) == [] and id_index.conflicts(ids, missing).count() == 0

    def failing(*_):
        raise OSError("listing failed")

    monkeypatch.setattr(id_index, "_file_system", failing)
    with pytest.raises(OSError, match="listing failed"):
        ingest.insert_batch(spark.createDataFrame([], ingest.FEEDBACK_SCHEMA), 0, missing)


def test_next_version_counts_old_versions_too(spark):
    rows = [(i, "churn", f"v{500 if i == 0 else i}", i) for i in range(150)]
    versions = spark.createDataFrame(rows, "id long, model_type string, version string, t long").select(
        "id", "model_type", "version", F.timestamp_seconds(F.col("t") * 86400).cast("timestamp_ntz").alias("created_at"))
    assert registry.next_versions(versions).first().next_version == "v501"


def test_drift_window_is_per_metric(spark):
    rows = [(i, 1, "often", 1.0, i + 100) for i in range(30)] + [(100, 1, "rare", 5.0, 50), (101, 1, "rare", 1.0, 40)]
    history = spark.createDataFrame(rows, "id long, model_version_id long, metric_name string, metric_value double, t long") \
        .withColumn("scoring_date", F.timestamp_seconds("t").cast("timestamp_ntz"))
    versions = spark.createDataFrame([(1, "churn")], "id long, model_type string")
    got = {r.metric_name: r.drift_detected for r in monitor.prediction_drift(history, versions).collect()}
    assert got == {"often": False, "rare": True}
    assert [r.metric_name for r in monitor.drift_details(history, versions).collect()] == ["rare"]


def test_latest_metric_tie_takes_the_larger_value(spark):
    rows = [(1, "test", "auc", 0.5, 10), (1, "test", "auc", 0.7, 10), (1, "test", "auc", 0.9, 5), (2, "test", "auc", 0.1, 1)]
    metrics = spark.createDataFrame(rows, "model_version_id long, dataset_type string, metric_name string, "
                                          "metric_value double, t long").withColumn(
        "created_at", F.timestamp_seconds("t").cast("timestamp_ntz"))
    got = {r.model_version_id: r.metric_value for r in registry.latest_version_metrics(metrics).collect()}
    assert got == {1: 0.7, 2: 0.1}


def test_batch_duplicates_are_inserted_once(spark):
    old = spark.createDataFrame([("a", 1)], "id string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 5), (None, 5)], "id string, v int")
    got = sorted((r.id or "", r.v) for r in sinks.insert_if_absent(old, batch, "id", order_col="v").collect())
    assert got == [("", 5), ("", 5), ("b", 2)]


def test_completed_runs_are_closed(spark):
    runs = spark.createDataFrame([(1, "running", None, None, None, None), (2, "running", None, None, None, None)],
                                 "run_id long, status string, training_samples long, test_samples long, "
                                 "error_message string, completed_at timestamp_ntz")
    done = spark.createDataFrame([(1, "completed", 5, 2, None)],
                                 "run_id long, status string, training_samples long, test_samples long, error_message string")
    got = {r.run_id: (r.status, r.training_samples, r.completed_at is not None)
           for r in registry.complete_runs(runs, done).collect()}
    assert got == {1: ("completed", 5, True), 2: ("running", None, False)}
