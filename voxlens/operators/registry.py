"""Model-registry rules over all model types at once.

"Latest per group" picks are ``max(struct(order..., payload))`` aggregates:
they combine map-side, so a model type or version holding a third of the
registry rows still ships one row per map task. "Newest N" uses
``row_number() <= N``, which Catalyst plans with a window-group limit before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.config import PROMOTION_THRESHOLD, VERSION_HISTORY_LIMIT
from voxlens.functions.scalars import relative_improvement, version_major
from voxlens.functions.time import as_of_lit
from voxlens.operators.sinks import upsert
from voxlens.session import materialize

VERSION_COLS = ("id", "model_type", "version", "status", "created_at", "hyperparameters")


def latest_version_metrics(metrics: DataFrame, dataset_type: str | None = "test") -> DataFrame:
    """Latest value of each metric of each version (newest ``created_at``,
    ties by the larger value)."""
    m = metrics if dataset_type is None else metrics.filter(F.col("dataset_type") == dataset_type)
    keys = ("model_version_id", "dataset_type", "metric_name")
    # Fixed-width buffers at both levels (hash aggregates; a struct max would sort the log).
    ties = m.groupBy(*keys, "created_at").agg(F.max("metric_value").alias("metric_value"))
    return ties.groupBy(*keys).agg(F.max_by("metric_value", "created_at").alias("metric_value"),
                                   F.max("created_at").alias("created_at"))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Newest version per model type (``created_at`` desc, ``id`` desc)."""
    payload = [c for c in versions.columns if c not in ("model_type", "created_at", "id")]
    best = F.max(F.struct("created_at", "id", *payload)).alias("b")
    return versions.groupBy("model_type").agg(best).select(
        F.col("b.id").alias("id"), "model_type", *[F.col(f"b.{c}").alias(c) for c in payload],
        F.col("b.created_at").alias("created_at"))


def ranked_versions(versions: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("model_type").orderBy(F.col("created_at").desc(), F.col("id").desc())
    return versions.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def version_history(versions: DataFrame, n: int = VERSION_HISTORY_LIMIT) -> DataFrame:
    """Newest ``n`` versions per model type with their rank."""
    return ranked_versions(versions, n)


def previous_versions(versions: DataFrame) -> DataFrame:
    """Second newest version id per type, or the only one."""
    top2 = ranked_versions(versions.select("model_type", "id", "created_at"), 2)
    return top2.groupBy("model_type").agg(
        F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("id"))),
                   F.max(F.when(F.col("rn") == 1, F.col("id")))).alias("previous_version_id"))


def active_versions(versions: DataFrame, deployments: DataFrame) -> DataFrame:
    """The deployed version row of each model type."""
    d = deployments.select(F.col("model_type").alias("deployed_type"), "active_version_id")
    return (versions.join(d, F.col("id") == F.col("active_version_id"), "inner")
            .select(*[F.col("deployed_type").alias(c) if c == "model_type" else F.col(c) for c in versions.columns]))


def next_versions(versions: DataFrame) -> DataFrame:
    """L6 + X15: ``v{max major + 1}`` over all versions (an old version may have the
    largest number), ``v1`` if none parse."""
    return versions.groupBy("model_type").agg(F.max(version_major("version")).alias("max_major")).select(
        "model_type",
        F.coalesce("max_major", F.lit(0)).alias("max_major"),
        F.concat(F.lit("v"), (F.coalesce("max_major", F.lit(0)) + 1).cast("string")).alias("next_version"))


def hyperparameters_parsed(versions: DataFrame) -> DataFrame:
    """JSON text -> ``map<string,string>`` -> typed columns."""
    m = F.from_json("hyperparameters", "map<string,string>")
    return versions.select("id", "model_type", m.alias("hp")).select(
        "id", "model_type",
        F.col("hp")["lookback_days"].cast("int").alias("lookback_days"),
        F.col("hp")["epochs"].cast("int").alias("epochs"),
        F.size(F.map_keys("hp")).alias("n_params"))


def comparison_pairs(versions: DataFrame, deployments: DataFrame) -> DataFrame:
    """Candidate (newest) and active version of every model type; ``previous``
    is NULL when nothing is deployed yet."""
    newest = latest_versions(versions.select("model_type", "id", "created_at")).select(
        "model_type", F.col("id").alias("new_version_id"))
    active = deployments.select("model_type", F.col("active_version_id").alias("previous_version_id"))
    return newest.join(active, "model_type", "left")


def metrics_of(metrics: DataFrame, version_ids: DataFrame) -> DataFrame:
    """Restrict the metrics log to the given version ids *before* any
    aggregation (a semi join; the id list has at most two rows per model type
    and is broadcast by the planner's size check when small)."""
    ids = version_ids.select(F.col("id").alias("_vid")).where(F.col("_vid").isNotNull()).distinct()
    return metrics.join(ids, F.col("model_version_id") == F.col("_vid"), "left_semi")


def version_improvements(pairs: DataFrame, metrics: DataFrame) -> DataFrame:
    """J3 + X19: metrics of both versions aligned by name, a missing side = 0."""
    ids = pairs.select(F.col("new_version_id").alias("id")).unionByName(
        pairs.select(F.col("previous_version_id").alias("id")))
    latest = latest_version_metrics(metrics_of(metrics, ids), "test").select(
        "model_version_id", "metric_name", "metric_value")
    prev = pairs.where(F.col("previous_version_id").isNotNull()).join(
        latest.withColumnRenamed("model_version_id", "previous_version_id")
        .withColumnRenamed("metric_value", "prev_value"), "previous_version_id")
    new = pairs.where(F.col("previous_version_id").isNotNull()).join(
        latest.withColumnRenamed("model_version_id", "new_version_id")
        .withColumnRenamed("metric_value", "new_value"), "new_version_id")
    j = prev.select("model_type", "metric_name", "prev_value").join(
        new.select("model_type", "metric_name", "new_value"), ["model_type", "metric_name"], "full_outer")
    j = j.join(pairs, "model_type")
    pv, nv = F.coalesce("prev_value", F.lit(0.0)), F.coalesce("new_value", F.lit(0.0))
    return j.select("model_type", "previous_version_id", "new_version_id", "metric_name",
                    pv.alias("prev_value"), nv.alias("new_value"), relative_improvement(nv, pv).alias("improvement"))


def promotion_decisions(versions: DataFrame, deployments: DataFrame, metrics: DataFrame,
                        threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """L7 + A19: promote when the mean improvement is strictly above the
    threshold (no metrics: mean 0); with no active version, always promote.

    The (candidate, active) pairs -- one row per model type -- are
    materialised once and reused by every branch instead of re-deriving them
    from the version log in each.
    """
    pairs = materialize(comparison_pairs(versions, deployments), "comparison_pairs")
    imp = version_improvements(pairs, metrics).groupBy("model_type").agg(
        F.avg("improvement").alias("avg_improvement"), F.count(F.lit(1)).alias("n_metrics"),
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric_name", "improvement")))))
        .alias("metric_improvements"))
    j = pairs.join(imp, "model_type", "left")
    first = F.col("previous_version_id").isNull()
    avg = F.coalesce("avg_improvement", F.lit(0.0))
    return j.select(
        "model_type", "previous_version_id", "new_version_id",
        F.when(first, F.lit(None).cast("double")).otherwise(avg).alias("average_improvement"),
        F.coalesce("n_metrics", F.lit(0)).alias("n_metrics"),
        (first | (avg > F.lit(threshold))).alias("promotion_recommended"),
        F.when(first, F.lit("first_deployment"))
        .when(avg > F.lit(threshold), F.lit("improvement_above_threshold"))
        .otherwise(F.lit("improvement_below_threshold")).alias("promotion_reason"),
        F.lit(threshold).alias("promotion_threshold"),
        "metric_improvements")


def model_comparisons(decisions: DataFrame, as_of: str | None = None) -> DataFrame:
    """L7's log: one comparison row per model type that has a previous version,
    with the improvement of every metric as JSON."""
    return decisions.where(F.col("previous_version_id").isNotNull()).select(
        "model_type", "previous_version_id", "new_version_id", "metric_improvements", "average_improvement",
        "promotion_recommended", "promotion_reason", as_of_lit(as_of).alias("comparison_timestamp"))


def complete_runs(runs: DataFrame, done: DataFrame, as_of: str | None = None) -> DataFrame:
    """Close the runs named in ``done`` (run_id, status, training_samples,
    test_samples, error_message and, if it has one, completed_at; ``as_of``
    else); other rows keep what they have."""
    at = F.col("completed_at") if "completed_at" in done.columns else as_of_lit(as_of)
    patch = done.select(at.alias("_new_completed_at"), F.col("run_id"), *[F.col(c).alias(f"_new_{c}") for c in (
        "status", "training_samples", "test_samples", "error_message")], F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    taken = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in (
        "status", "training_samples", "test_samples", "error_message")}
    taken["completed_at"] = F.when(hit, F.col("_new_completed_at")).otherwise(F.col("completed_at"))
    return runs.join(patch, "run_id", "left").select(*[taken.get(c, F.col(c)).alias(c) for c in runs.columns])


def deploy_versions(deployments: DataFrame, patch: DataFrame, as_of: str | None = None) -> DataFrame:
    """L12 (S3 + S7): point each patched model type at ``version_id``, keep the
    previous active id, ``rollback_available = previous IS NOT NULL``."""
    cur = deployments.select("model_type", "active_version_id")
    base = cur.select("model_type", "active_version_id",
                      F.lit(None).cast("long").alias("previous_version_id"),
                      F.lit(False).alias("rollback_available"),
                      F.lit(None).cast("timestamp_ntz").alias("deployed_at"))
    inc = patch.join(cur.withColumnRenamed("active_version_id", "prev_id"), "model_type", "left").select(
        "model_type", F.col("version_id").alias("active_version_id"),
        F.col("prev_id").alias("previous_version_id"),
        F.col("prev_id").isNotNull().alias("rollback_available"),
        as_of_lit(as_of).alias("deployed_at"))
    return upsert(base, inc, ["model_type"],
                  ["active_version_id", "previous_version_id", "rollback_available", "deployed_at"])


DEPLOYMENT_COLS = ("active_version_id", "previous_version_id", "rollback_available", "deployed_at")


def deployment_intervals(log: DataFrame, sequence: str = "entry") -> DataFrame:
    """L12's history: each deployment of a (model_type, active_version_id, deployed_at,
    ``sequence``) log with the time it held, [valid_from, valid_to), the version it
    replaced, and whether it went back to a version deployed before (``is_rollback``).

    Deployments of one instant follow each other by ``sequence``: all but the last hold
    for no time. The window runs over a model type's deployments, not over versions.
    """
    per_type = Window.partitionBy("model_type")
    order = per_type.orderBy("deployed_at", sequence)
    before = Window.partitionBy("model_type", "active_version_id").orderBy("deployed_at", sequence)
    return log.select(
        "model_type", "active_version_id", F.lag("active_version_id").over(order).alias("previous_version_id"),
        F.col("deployed_at").alias("valid_from"), F.lead("deployed_at").over(order).alias("valid_to"),
        F.col(sequence).alias("sequence"), F.row_number().over(order).alias("deployment_no"),
        (F.row_number().over(before) > 1).alias("is_rollback"))


def deployments_as_of(log: DataFrame, as_of: str | None = None, sequence: str = "entry") -> DataFrame:
    """The deployment that held at ``as_of`` for each model type: the last one up to then,
    of one instant the one of the largest ``sequence``. One partial aggregate, no window."""
    cols = [c for c in DEPLOYMENT_COLS if c in log.columns]
    held = log.where(F.col("deployed_at") <= as_of_lit(as_of))
    last = held.groupBy("model_type").agg(
        F.max(F.struct("deployed_at", sequence, *[c for c in cols if c != "deployed_at"])).alias("d"))
    return last.select("model_type", *[F.col(f"d.{c}").alias(c) for c in cols])


def version_status_from_log(versions: DataFrame, log: DataFrame, as_of: str | None = None,
                            sequence: str = "entry") -> DataFrame:
    """Of the versions ever deployed up to ``as_of`` those that hold then are ``active``,
    the others ``inactive``; versions never deployed keep their status."""
    active = deployments_as_of(log, as_of, sequence).select(
        F.col("active_version_id").alias("id"), F.lit("active").alias("new_status"))
    once = log.where(F.col("deployed_at") <= as_of_lit(as_of)).select(F.col("active_version_id").alias("id")).distinct()
    patch = once.join(active, "id", "left").select("id", F.coalesce("new_status", F.lit("inactive")).alias("new_status"))
    return versions.join(patch, "id", "left").select(
        *[F.coalesce("new_status", "status").alias("status") if c == "status" else F.col(c) for c in versions.columns])


def run_summary(runs: DataFrame) -> DataFrame:
    """L4 + S7: runs of each model type by status, their samples, and the newest error."""
    failed = F.col("status") == "failed"
    newest = F.max(F.when(failed, F.struct("completed_at", "run_id", "error_message"))).alias("e")
    return runs.groupBy("model_type").agg(
        F.count("*").alias("n_runs"), F.count_if(F.col("status") == "running").alias("n_running"),
        F.count_if(F.col("status") == "completed").alias("n_completed"), F.count_if(failed).alias("n_failed"),
        F.sum("training_samples").alias("training_samples"), F.max("completed_at").alias("last_completed_at"),
        newest).select("*", F.col("e.run_id").alias("last_failed_run"), F.col("e.error_message").alias("last_error")).drop("e")


def version_status_after_deploy(versions: DataFrame, new_deployments: DataFrame) -> DataFrame:
    """The newly active versions become ``active``, the ones they replace
    ``inactive``; other rows keep their status.

    The patch has at most two rows per model type, so it is applied with a
    left join (the planner broadcasts it after its size check) rather than a
    full outer upsert that would shuffle the whole version log.
    """
    act = new_deployments.where(F.col("deployed_at").isNotNull())
    on = act.select(F.col("active_version_id").alias("id"), F.lit("active").alias("new_status"))
    off = act.where(F.col("previous_version_id").isNotNull()).select(
        F.col("previous_version_id").alias("id"), F.lit("inactive").alias("new_status"))
    # A version both replaced and re-deployed stays active ("active" < "inactive").
    patch = on.unionByName(off).groupBy("id").agg(F.min("new_status").alias("new_status"))
    return versions.join(patch, "id", "left").select(
        *[F.coalesce("new_status", "status").alias("status") if c == "status" else F.col(c)
          for c in versions.columns])
