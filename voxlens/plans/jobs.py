"""Jobs: the reference's user-facing runs as compositions of the operators
and the snapshot sinks. Each job reads the base tables under ``root``, writes
a new snapshot directory under ``out`` (never the one it reads) and returns
its path. An external orchestrator schedules them; there is no scheduler here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.config import (
    ACCOUNT_FEATURE_COLS,
    DEFAULT_AS_OF,
    DEFAULT_MODEL_VERSION,
    DEFAULT_TEST_SIZE,
    LOOKBACK_DAYS,
)
from voxlens.functions.time import as_of_lit
from voxlens.operators import artifacts, features, learn, logs, monitor, registry, scoring, sinks
from voxlens.session import prepare
from voxlens.sources.tables import Tables

ACCOUNT_UPDATE_COLS = ("churn_probability", "health_score", "risk_category", "predicted_at", "model_version")
AREA_UPDATE_COLS = ("priority_score", "feedback_count", "avg_sentiment_score", "negative_count", "critical_count",
                    "predicted_at", "model_version")


def _snapshot_id(as_of: str | None) -> str:
    return (as_of or DEFAULT_AS_OF).replace(" ", "T").replace(":", "")


def _publish(spark: SparkSession, new: DataFrame, out: str, table: str, keys, update_cols,
             as_of: str | None, previous: str | None) -> str:
    if previous is not None:
        new = sinks.upsert(sinks.read_snapshot(spark, out, table, previous), new, keys, update_cols)
    return sinks.write_snapshot(new, out, table, _snapshot_id(as_of))


def score_areas(spark: SparkSession, root: str, out: str, as_of: str | None = None,
                model_version: str = DEFAULT_MODEL_VERSION, previous: str | None = None,
                model_path: str | None = None) -> str:
    """L2 + S3: score product areas (with the weights stored under ``model_path``,
    if any) and upsert over snapshot ``previous``."""
    prepare(spark)
    weights = artifacts.load_weights(spark, model_path) if model_path else None
    impact = scoring.product_area_impact(Tables(spark, root).feedback, as_of, model_version=model_version,
                                         weights=weights)
    return _publish(spark, impact, out, "product_area_impact", ["product_area", "segment"], AREA_UPDATE_COLS,
                    as_of, previous)


def score_accounts(spark: SparkSession, root: str, out: str, as_of: str | None = None,
                   model_version: str = DEFAULT_MODEL_VERSION, previous: str | None = None,
                   model_path: str | None = None) -> str:
    """L1 + S3: score accounts (per user) and upsert over snapshot ``previous``.

    With ``model_path`` the pipeline, scaler and region codes of that training
    run are used; what is not stored there falls back to the defaults."""
    prepare(spark)
    stored = {} if model_path is None else {
        "scaler": artifacts.load_scaler(spark, model_path), "codes": artifacts.load_codes(spark, model_path),
        "model": artifacts.load_pipeline(spark, model_path)}
    scores = scoring.account_risk_scores(Tables(spark, root).feedback, as_of, model_version=model_version, **stored)
    return _publish(spark, scores, out, "account_risk_scores", ["account_id"], ACCOUNT_UPDATE_COLS,
                    as_of, previous)


CHURN_JOB_MIN_NEW_RECORDS = {"churn": 10, None: 100}  # the churn job lowers the default of 100 to 10


def retrain_check(spark: SparkSession, root: str, out: str, as_of: str | None = None,
                  min_new_records: int | dict = CHURN_JOB_MIN_NEW_RECORDS) -> DataFrame:
    """L3 + S5: decide for every model type and append the decisions to the
    freshness log; returns the decisions."""
    prepare(spark)
    t = Tables(spark, root)
    decisions = monitor.retrain_decisions(t.feedback_core, t.model_versions, as_of,
                                          min_new_records=min_new_records)
    sinks.append_log(monitor.data_freshness_log(decisions, as_of), out, "data_freshness_log")
    return decisions


def status(spark: SparkSession, root: str, out: str, snapshot: str) -> DataFrame:
    """Row counts of the facts and of one published snapshot."""
    prepare(spark)
    return sinks.table_status({
        "feedback_enriched": Tables(spark, root).feedback_core,
        "account_risk_scores": sinks.read_snapshot(spark, out, "account_risk_scores", snapshot),
        "product_area_impact": sinks.read_snapshot(spark, out, "product_area_impact", snapshot),
    })


# Registry logs that the training jobs append to (S5), under the output folder.
VERSIONS = "id long, model_type string, version string, status string, created_at timestamp_ntz, hyperparameters string"
METRICS = "model_version_id long, metric_name string, metric_value double, dataset_type string, created_at timestamp_ntz"
DEPLOYMENTS = ("model_type string, active_version_id long, previous_version_id long, rollback_available boolean, "
               "deployed_at timestamp_ntz")
STARTS = "run_id long, model_version_id long, model_type string, triggered_by string, started_at timestamp_ntz"
RUNS = ("run_id long, model_version_id long, model_type string, status string, training_samples long, "
        "test_samples long, error_message string, completed_at timestamp_ntz")


def read_log(spark: SparkSession, out: str, table: str, schema: str) -> DataFrame:
    """A registry log; empty where nothing has been logged yet."""
    return logs.read(spark, out, table, schema).drop(logs.ENTRY)


def _deployments(spark: SparkSession, out: str) -> DataFrame:
    return logs.read(spark, out, "model_deployments", DEPLOYMENTS)


def deployed(spark: SparkSession, out: str, as_of: str | None = None) -> DataFrame:
    """The deployment of each model type that holds now, or held at ``as_of``."""
    log = _deployments(spark, out)
    newest = log.agg(F.max("deployed_at")).first()[0] if as_of is None else None
    return registry.deployments_as_of(log, as_of if newest is None else str(newest))


def deployment_history(spark: SparkSession, out: str) -> DataFrame:
    """Every deployment with the time it held."""
    return registry.deployment_intervals(_deployments(spark, out))


def deploy(spark: SparkSession, out: str, patch: DataFrame, as_of: str | None = None) -> None:
    """L12 + S7: log the deployment of each (model_type, version_id) of ``patch``; of one
    instant the later logged one holds. Refused where a patched type has a deployment
    after ``as_of``, which would go on to hold."""
    now = deployed(spark, out)
    late = now.join(patch.select("model_type"), "model_type", "left_semi").where(F.col("deployed_at") > as_of_lit(as_of))
    if names := sorted(r.model_type for r in late.select("model_type").collect()):
        raise ValueError(f"deployed after {as_of or DEFAULT_AS_OF} already: {', '.join(names)}")
    after = registry.deploy_versions(now.select("model_type", "active_version_id"), patch, as_of)
    rows = after.join(patch.select("model_type"), "model_type", "left_semi")
    sinks.append_log(rows.select(*[c.split()[0] for c in DEPLOYMENTS.split(", ")]), out, "model_deployments")


def rollback(spark: SparkSession, out: str, model_type: str, as_of: str | None = None) -> int:
    """Deploy again the version that the current deployment of ``model_type`` replaced; its id."""
    now = deployed(spark, out).where(F.col("model_type") == model_type).first()
    if now is None or not now.rollback_available:
        raise ValueError(f"nothing to roll {model_type} back to")
    patch = spark.createDataFrame([(model_type, now.previous_version_id)], "model_type string, version_id long")
    deploy(spark, out, patch, as_of)
    return now.previous_version_id


def version_status(spark: SparkSession, out: str, as_of: str | None = None) -> DataFrame:
    """The version log with the statuses that the deployments imply now, or implied at ``as_of``."""
    versions, log = read_log(spark, out, "model_versions", VERSIONS), _deployments(spark, out)
    newest = log.agg(F.max("deployed_at")).first()[0] if as_of is None else None
    return registry.version_status_from_log(versions, log, as_of if newest is None else str(newest))


def _register(spark: SparkSession, out: str, model_type: str, as_of: str | None, hyperparameters: str):
    """A new version row of ``model_type``; (id, version). Id and version number are
    claimed, so that jobs running at once get different ones."""
    versions, folder = read_log(spark, out, "model_versions", VERSIONS), f"{out.rstrip('/')}/model_versions"
    found = registry.next_versions(versions.where(F.col("model_type") == model_type)).first()
    version = f"v{logs.claim(spark, folder, f'versions-{model_type}', found.max_major + 1 if found else 1)}"
    version_id = logs.claim(spark, folder, "ids", (versions.agg(F.max("id")).first()[0] or 0) + 1)
    row = spark.range(1).select(
        F.lit(version_id).cast("long").alias("id"), F.lit(model_type).alias("model_type"), F.lit(version).alias("version"),
        F.lit("training").alias("status"), as_of_lit(as_of).alias("created_at"), F.lit(hyperparameters).alias("hyperparameters"))
    sinks.append_log(row, out, "model_versions")
    return version_id, version


class _Run:
    """L4: a training run's life. Its start is logged on entry; leaving by an exception logs it as
    failed with the error's text, and the exception goes on."""

    def __init__(self, spark: SparkSession, out: str, model_type: str, version_id: int, as_of: str | None, triggered_by: str):
        self.spark, self.out, self.model_type, self.version_id, self.as_of = spark, out, model_type, version_id, as_of
        self.run_id = logs.claim(spark, f"{out.rstrip('/')}/training_runs", "ids")
        self.triggered_by, self.closed = triggered_by, False

    def __enter__(self):
        start = self.spark.createDataFrame([(self.run_id, self.version_id, self.model_type, self.triggered_by)],
                                           "run_id long, model_version_id long, model_type string, triggered_by string")
        sinks.append_log(start.withColumn("started_at", as_of_lit(self.as_of)), self.out, "training_run_starts")
        return self

    def close(self, status: str, training_samples: int, test_samples: int, error_message: str | None) -> None:
        row = (self.run_id, self.version_id, self.model_type, status, training_samples, test_samples, error_message)
        run = self.spark.createDataFrame([row], RUNS.rsplit(", ", 1)[0])
        sinks.append_log(run.withColumn("completed_at", as_of_lit(self.as_of)), self.out, "training_runs")
        self.closed = True

    def __exit__(self, kind, error, trace) -> bool:
        if error is not None and not self.closed:
            self.close("failed", 0, 0, f"{type(error).__name__}: {error}"[:2000])
        return False


def training_runs(spark: SparkSession, out: str) -> DataFrame:
    """Every run that has started, with the figures of those that have ended (``running`` else)."""
    started = read_log(spark, out, "training_run_starts", STARTS).select(
        "*", F.lit("running").alias("status"), F.lit(None).cast("long").alias("training_samples"),
        F.lit(None).cast("long").alias("test_samples"), F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    return registry.complete_runs(started, read_log(spark, out, "training_runs", RUNS))


def _promote(spark: SparkSession, out: str, model_type: str, version_id: int, as_of: str | None) -> bool:
    """Compare with the deployed version, log the comparison, deploy if recommended."""
    versions = read_log(spark, out, "model_versions", VERSIONS).where(F.col("model_type") == model_type)
    active = deployed(spark, out).where(F.col("model_type") == model_type)
    decision = registry.promotion_decisions(versions, active, read_log(spark, out, "model_metrics", METRICS))
    sinks.append_log(registry.model_comparisons(decision, as_of), out, "model_comparisons")
    promoted = bool(decision.first().promotion_recommended)
    if promoted:
        deploy(spark, out, spark.createDataFrame([(model_type, version_id)], "model_type string, version_id long"), as_of)
    return promoted


def train_churn(spark: SparkSession, root: str, out: str, as_of: str | None = None, force: bool = False,
                test_size: float = DEFAULT_TEST_SIZE, kind: str = "logistic",
                lookback_days: int = LOOKBACK_DAYS, triggered_by: str = "manual") -> dict | None:
    """L4: freshness check, version row, run start, fit, metrics and distribution of the fitted
    model, stored artifacts, run end, comparison and deployment.

    Returns what happened (version, path, status, promoted), or None where the
    check says that there is too little new data. An exception leaves a failed run behind."""
    prepare(spark)
    t = Tables(spark, root)
    types = spark.createDataFrame([("churn",)], "model_type string")
    decisions = monitor.retrain_decisions(
        t.feedback_core, read_log(spark, out, "model_versions", VERSIONS), as_of, model_types=types,
        min_new_records=CHURN_JOB_MIN_NEW_RECORDS)
    sinks.append_log(monitor.data_freshness_log(decisions, as_of), out, "data_freshness_log")
    if not force and not decisions.first().decision_to_retrain:
        return None
    version_id, version = _register(spark, out, "churn", as_of, f'{{"lookback_days": "{lookback_days}", "kind": "{kind}"}}')
    path, promoted = artifacts.folder(out, "churn", version), False
    with _Run(spark, out, "churn", version_id, as_of, triggered_by) as run:
        base = features.account_features(t.feedback, as_of, lookback_days, grain="user")
        split = learn.stratified_split(learn.synthetic_labels(base), test_size)
        record = learn.training_run_record(split).first()
        if record.status == "completed":
            _fit_churn(spark, out, path, version_id, split, features.region_codes(base), kind, as_of)
        run.close(record.status, record.training_samples, record.test_samples, record.error_message)
    if record.status == "completed":
        promoted = _promote(spark, out, "churn", version_id, as_of)
    return {"version_id": version_id, "version": version, "status": record.status, "promoted": promoted, "path": path,
            "run_id": run.run_id}


def _fit_churn(spark: SparkSession, out: str, path: str, version_id: int, split: DataFrame, codes: DataFrame, kind: str,
               as_of: str | None) -> None:
    """M4: fit on the training rows, store the artifacts, log metrics and distribution of the test rows."""
    kept = ("account_id", "churned", "is_test")
    matrix = features.feature_matrix(split, keys=kept)
    scaler = scoring.fit_scaler(matrix.where(~F.col("is_test")), ACCOUNT_FEATURE_COLS)
    data = scoring.standardize(matrix, keys=kept, stats=scaler)
    model = learn.fit_churn_classifier(data.where(~F.col("is_test")), kind=kind)
    artifacts.save_churn(path, model, scaler, codes)
    preds = learn.predict_churn(model, data.where("is_test"), keep=kept)
    row = learn.classification_metrics(preds).first()
    metrics = [(m, row[m]) for m in ("accuracy", "precision", "recall", "f1", "auc") if row[m] is not None]
    at = as_of_lit(as_of)
    sinks.append_log(spark.createDataFrame(metrics, "metric_name string, metric_value double").select(
        F.lit(version_id).cast("long").alias("model_version_id"), "metric_name", "metric_value",
        F.lit("test").alias("dataset_type"), at.alias("created_at")), out, "model_metrics")
    sinks.append_log(learn.prediction_distribution(preds).select(
        F.lit(version_id).cast("long").alias("model_version_id"), F.lit("churn").alias("model_type"), "metric_name",
        "metric_value", "samples_count", at.alias("scoring_date")), out, "prediction_distribution_history")


def train_areas(spark: SparkSession, root: str, out: str, as_of: str | None = None,
                overrides: DataFrame | None = None, triggered_by: str = "manual") -> dict:
    """A version of the rule-based area scorer with its weights, its score statistics as metrics, and its run."""
    prepare(spark)
    t = Tables(spark, root)
    version_id, version = _register(spark, out, "product_area", as_of, "{}")
    path = artifacts.folder(out, "product_area", version)
    with _Run(spark, out, "product_area", version_id, as_of, triggered_by) as run:
        weights = scoring.effective_weights(scoring.default_weights(spark), overrides)
        artifacts.save_weights(weights, path)
        scored = scoring.area_scores(features.area_features(t.feedback, as_of), artifacts.load_weights(spark, path))
        row = scored.agg(F.count("*").alias("n"), F.avg("priority_score").alias("mean"),
                         F.stddev_pop("priority_score").alias("std")).first()
        status = "completed" if row.n else "failed"
        if row.n:
            sinks.append_log(spark.createDataFrame([("score_mean", row["mean"]), ("score_std", row["std"])],
                                                   "metric_name string, metric_value double").select(
                F.lit(version_id).cast("long").alias("model_version_id"), "metric_name", "metric_value",
                F.lit("test").alias("dataset_type"), as_of_lit(as_of).alias("created_at")), out, "model_metrics")
        run.close(status, row.n, 0, None if row.n else "No data available for training")
    if row.n:
        deploy(spark, out, spark.createDataFrame([("product_area", version_id)], "model_type string, version_id long"), as_of)
    return {"version_id": version_id, "version": version, "status": status, "path": path, "run_id": run.run_id}
