"""Logs and numbers under several writers, order of deployments, life of a training run."""

from __future__ import annotations

import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from voxlens.operators import learn, logs, registry, sinks
from voxlens.plans import jobs


def patch(spark, model_type, version_id):
    return spark.createDataFrame([(model_type, version_id)], "model_type string, version_id long")


def active(spark, out, as_of=None):
    return {r.model_type: r.active_version_id for r in jobs.deployed(spark, out, as_of).collect()}


def test_claims_are_unique_under_threads(spark):
    out = tempfile.mkdtemp(prefix="voxlens-claims-")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: logs.claim(spark, out, "n"), range(24)))
    assert sorted(got) == list(range(1, 25))
    assert logs.claim(spark, out, "n", first=100) == 100 and logs.claim(spark, out, "other") == 1
    assert not logs.create_marker(spark, f"{out}/_claims/n/7")


def test_appends_at_once_lose_nothing(spark):
    out = tempfile.mkdtemp(prefix="voxlens-append-")
    frames = [spark.range(k * 10, k * 10 + 10).toDF("v") for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda df: logs.append(df, out, "log"), frames))
    assert sorted(numbers) == list(range(1, 7))
    stored = logs.read(spark, out, "log", "v long")
    assert sorted(r.v for r in stored.collect()) == list(range(60))
    assert stored.groupBy("entry").count().where("count <> 10").count() == 0
    assert logs.read(spark, out, "none", "v long").collect() == []


def test_an_append_that_fails_leaves_no_entry(spark):
    out = tempfile.mkdtemp(prefix="voxlens-append-")
    logs.append(spark.range(3).toDF("v"), out, "log")
    with pytest.raises(Exception):
        logs.append(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("v")), out, "log")
    assert logs.read(spark, out, "log", "v long").count() == 3


def test_interleaved_registrations_get_two_versions(spark, monkeypatch):
    """A second job registers between the first one's read and its commit."""
    out = tempfile.mkdtemp(prefix="voxlens-two-")
    plain, inner = registry.next_versions, []

    def between(versions):
        found = plain(versions).collect()
        if not inner:
            inner.append(None)
            inner[0] = jobs._register(spark, out, "churn", None, "{}")
        return spark.createDataFrame(found, "model_type string, max_major long, next_version string")

    monkeypatch.setattr(registry, "next_versions", between)
    outer = jobs._register(spark, out, "churn", None, "{}")
    assert {outer[1], inner[0][1]} == {"v1", "v2"} and outer[0] != inner[0][0]
    monkeypatch.undo()
    rows = jobs.read_log(spark, out, "model_versions", jobs.VERSIONS).collect()
    assert len({r.id for r in rows}) == len({r.version for r in rows}) == 2
    assert jobs._register(spark, out, "churn", None, "{}")[1] == "v3"
    assert jobs._register(spark, out, "other", None, "{}")[1] == "v1"


def test_registrations_of_many_threads(spark):
    out = tempfile.mkdtemp(prefix="voxlens-many-")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: jobs._register(spark, out, "churn", None, "{}"), range(8)))
    assert sorted(v for _, v in got) == sorted(f"v{k}" for k in range(1, 9)) and len({i for i, _ in got}) == 8
    assert jobs.read_log(spark, out, "model_versions", jobs.VERSIONS).count() == 8


def test_a_rollback_of_the_same_instant_holds(spark):
    out = tempfile.mkdtemp(prefix="voxlens-roll-")
    for version in (5, 3, 9):
        jobs.deploy(spark, out, patch(spark, "churn", version))
        assert active(spark, out) == {"churn": version}
    assert jobs.rollback(spark, out, "churn") == 3 and active(spark, out) == {"churn": 3}
    history = jobs.deployment_history(spark, out).orderBy("sequence").collect()
    assert [(r.active_version_id, r.previous_version_id, r.is_rollback) for r in history] == [
        (5, None, False), (3, 5, False), (9, 3, False), (3, 9, True)]
    assert [r.valid_to == r.valid_from for r in history] == [True, True, True, False] and history[-1].valid_to is None


def test_deployments_as_of_a_past_date(spark):
    out = tempfile.mkdtemp(prefix="voxlens-past-")
    for day, model_type, version in (("2024-01-01", "churn", 1), ("2024-01-05", "churn", 2), ("2024-01-05", "area", 7),
                                     ("2024-01-09", "churn", 1)):
        jobs.deploy(spark, out, patch(spark, model_type, version), f"{day} 00:00:00")
    want = {"2023-12-31": {}, "2024-01-01": {"churn": 1}, "2024-01-04": {"churn": 1}, "2024-01-05": {"churn": 2, "area": 7},
            "2024-01-09": {"churn": 1, "area": 7}}
    for day, held in want.items():
        assert active(spark, out, f"{day} 00:00:00") == held
    with pytest.raises(ValueError, match="churn"):
        jobs.deploy(spark, out, patch(spark, "churn", 4), "2024-01-08 00:00:00")
    with pytest.raises(ValueError):
        jobs.rollback(spark, out, "area")
    versions = spark.createDataFrame([(k, "m", f"v{k}", "training", None, "{}") for k in (1, 2, 3)], jobs.VERSIONS)
    sinks.append_log(versions, out, "model_versions")
    assert {r.id: r.status for r in jobs.version_status(spark, out).collect()} == {1: "active", 2: "inactive", 3: "training"}
    at = {r.id: r.status for r in jobs.version_status(spark, out, "2024-01-06 00:00:00").collect()}
    assert at == {1: "inactive", 2: "active", 3: "training"}


def test_intervals_meet_and_agree_with_the_lookup(spark):
    rows = [("a", 1, "2024-01-01 00:00:00", 1), ("a", 2, "2024-01-03 00:00:00", 3), ("a", 1, "2024-01-03 00:00:00", 2),
            ("b", 9, "2024-01-02 00:00:00", 4), ("a", 3, "2024-01-08 00:00:00", 5)]
    log = spark.createDataFrame(rows, "model_type string, active_version_id long, deployed_at string, entry long") \
        .withColumn("deployed_at", F.col("deployed_at").cast("timestamp_ntz"))
    spans = registry.deployment_intervals(log)
    for day in range(1, 12):
        at = f"2024-01-{day:02d} 12:00:00"
        moment = F.lit(at).cast("timestamp_ntz")
        held = spans.where((F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment)))
        assert sorted((r.model_type, r.active_version_id) for r in held.collect()) == sorted(
            (r.model_type, r.active_version_id) for r in registry.deployments_as_of(log, at).collect())


def test_a_failing_fit_leaves_a_failed_run(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="voxlens-fail-")

    def broken(*_, **__):
        raise RuntimeError("the fit broke")

    seen = {}

    def watched(*args, **kwargs):
        seen.update({r.run_id: r.status for r in jobs.training_runs(spark, out).collect()})
        broken()

    monkeypatch.setattr(learn, "fit_churn_classifier", watched)
    with pytest.raises(RuntimeError, match="the fit broke"):
        jobs.train_churn(spark, SMALL, out, force=True, test_size=0.2, triggered_by="test")
    assert list(seen.values()) == ["running"]
    run = jobs.training_runs(spark, out).collect()
    assert [(r.status, r.error_message, r.triggered_by) for r in run] == [("failed", "RuntimeError: the fit broke", "test")]
    assert jobs.deployed(spark, out).count() == 0
    monkeypatch.undo()
    done = jobs.train_churn(spark, SMALL, out, force=True, test_size=0.2)
    assert done["version"] == "v2" and done["run_id"] != run[0].run_id
    totals = registry.run_summary(jobs.training_runs(spark, out)).collect()
    assert [(r.n_runs, r.n_running, r.n_completed, r.n_failed, r.last_failed_run) for r in totals] == [
        (2, 0, 1, 1, run[0].run_id)]
    assert "the fit broke" in totals[0].last_error and totals[0].training_samples > 0
