"""Retrain decisions and model health (L3, L8-L11), for every model type in
one job instead of a Python loop per type.

Freshness (L3) needs, per model type, the number of feedback rows newer than
that type's last training. Rather than joining the fact table to the model
types (k x N pairs), each fact row is binned once by how many of the k sorted
training times it exceeds; the ``k + 1`` bin counts are the only thing
aggregated, and each type reads the bins above its own rank. The sorted
training times are a one-row array (k = number of model types) broadcast to
the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.config import (
    DEGRADATION_METRIC,
    DEGRADATION_THRESHOLD,
    DRIFT_THRESHOLD,
    DRIFT_WINDOW_ROWS,
    MAX_DAYS_WITHOUT_TRAINING,
    MIN_DAYS_SINCE_TRAINING,
    MIN_NEW_DATA_PERCENT,
    MIN_NEW_RECORDS,
    MIN_RULES_MET,
)
from voxlens.functions.scalars import abs_relative_change, fixed_1dp, percent_2dp
from voxlens.functions.time import as_of_lit, whole_days
from voxlens.operators.registry import active_versions, latest_version_metrics, metrics_of
from voxlens.session import materialize


def model_type_domain(versions: DataFrame, deployments: DataFrame | None = None) -> DataFrame:
    d = versions.select("model_type")
    if deployments is not None:
        d = d.unionByName(deployments.select("model_type"))
    return d.distinct()


def freshness_facts(feedback: DataFrame, last_training: DataFrame) -> DataFrame:
    """Per model type ``(latest_feedback_date, total_count, new_records)``
    with ``new_records = count(created_at > last_training_date)``; one scan.

    ``last_training``: ``(model_type, last_training_date)``; NULL date = never trained.
    """
    times = last_training.agg(
        F.sort_array(F.collect_list("last_training_date")).alias("ts"))  # k values, NULLs dropped
    binned = feedback.select("created_at").crossJoin(F.broadcast(times)).select(  # one-row side
        "created_at", F.size(F.filter("ts", lambda t: t < F.col("created_at"))).alias("bin"))
    bins = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.max("created_at").alias("mx"))
    summary = bins.agg(
        F.collect_list(F.struct("bin", "n")).alias("bins"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_count"),
        F.max("mx").alias("latest_feedback_date"))
    ranked = last_training.crossJoin(F.broadcast(times)).select(  # one-row side
        "model_type", "last_training_date",
        F.size(F.filter("ts", lambda t: t < F.col("last_training_date"))).alias("rank_lt"))
    new = F.aggregate(F.filter("bins", lambda b: b["bin"] > F.col("rank_lt")), F.lit(0).cast("long"),
                      lambda acc, b: acc + b["n"])
    return ranked.crossJoin(F.broadcast(summary)).select(  # one-row side
        "model_type", "last_training_date", "latest_feedback_date", "total_count",
        F.when(F.col("last_training_date").isNull(), F.col("total_count")).otherwise(new).alias("new_records"))


def retrain_decisions(feedback: DataFrame, versions: DataFrame, as_of: str | None = None,
                      model_types: DataFrame | None = None,
                      min_new_data_percent: float = MIN_NEW_DATA_PERCENT,
                      min_days_since_training: int = MIN_DAYS_SINCE_TRAINING,
                      min_new_records: int | dict = MIN_NEW_RECORDS) -> DataFrame:
    """L3: retrain when at least 2 of {days >= 7, new >= 100, new% >= 5} hold.

    First training (no version): all rows are new, 100 %, infinite days.
    No feedback at all: no retrain, reason "No feedback data available".
    ``min_new_records`` may be a ``{model_type: n}`` map (key ``None`` = the
    default), e.g. the churn job's own threshold of 10.
    """
    if isinstance(min_new_records, dict):
        overrides = {k: v for k, v in min_new_records.items() if k is not None}
        min_new = F.lit(int(min_new_records.get(None, MIN_NEW_RECORDS)))
        for mt, n in overrides.items():
            min_new = F.when(F.col("model_type") == mt, F.lit(int(n))).otherwise(min_new)
    else:
        min_new = F.lit(int(min_new_records))
    last = versions.groupBy("model_type").agg(F.max("created_at").alias("last_training_date"))
    domain = model_types if model_types is not None else versions.select("model_type").distinct()
    # k rows (one per model type), read twice by freshness_facts: materialise.
    last = materialize(domain.join(last, "model_type", "left"), "last_training")
    facts = freshness_facts(feedback, last)
    first = F.col("last_training_date").isNull()
    total, new = F.col("total_count"), F.col("new_records")
    pct = F.when(first, F.lit(100.0)).when(total > 0, new / total * F.lit(100.0)).otherwise(F.lit(0.0))
    days = whole_days(F.col("last_training_date"), as_of_lit(as_of))
    days_txt = F.when(first, F.lit("inf")).otherwise(days.cast("string"))
    c_days = first | (days >= F.lit(min_days_since_training))
    c_new = new >= min_new
    c_pct = pct >= F.lit(min_new_data_percent)
    met = c_days.cast("int") + c_new.cast("int") + c_pct.cast("int")
    reasons = F.concat_ws(
        " AND ",
        F.when(c_days, F.concat(days_txt, F.lit(f" days since last training (min: {min_days_since_training})"))),
        F.when(c_new, F.concat(new.cast("string"), F.lit(" new records (min: "), min_new.cast("string"),
                               F.lit(")"))),
        F.when(c_pct, F.concat(fixed_1dp(pct), F.lit(f"% new data (min: {float(min_new_data_percent)}%)"))))
    no_data = F.col("latest_feedback_date").isNull() | (total == 0)
    decide = ~no_data & (met >= F.lit(MIN_RULES_MET))
    reason = (F.when(no_data, F.lit("No feedback data available"))
              .when(decide, reasons)
              .otherwise(F.concat(F.lit("Insufficient data freshness: "), new.cast("string"), F.lit(" new records ("),
                                  fixed_1dp(pct), F.lit("%), "), days_txt, F.lit(" days since training"))))
    return facts.select(
        "model_type", "last_training_date", "latest_feedback_date", "total_count", "new_records",
        F.when(no_data, F.lit(None).cast("double")).otherwise(pct).alias("percent_new_data"),
        F.when(first, F.lit(None).cast("long")).otherwise(days).alias("days_since_training"),
        met.alias("rules_met"), decide.alias("decision_to_retrain"), reason.alias("reason"),
        (~no_data).alias("logged"))


def prediction_drift(history: DataFrame, versions: DataFrame, threshold: float = DRIFT_THRESHOLD,
                     window_rows: int = DRIFT_WINDOW_ROWS) -> DataFrame:
    """L8 (J2 + W5 + X18): within the newest ``window_rows`` history rows of each
    metric of a model type (a metric logged often does not push another out), the
    newest value against the mean of the older ones; drift when the relative
    change is strictly above ``threshold``.
    Needs at least two values; an older mean of 0 never drifts."""
    v = versions.select(F.col("id").alias("model_version_id"), F.col("model_type").alias("version_model_type"))
    h = history.select("id", "model_version_id", "metric_name", "metric_value", "scoring_date").join(
        v, "model_version_id")
    w_metric = Window.partitionBy("version_model_type", "metric_name").orderBy(
        F.col("scoring_date").desc(), F.col("id").desc())
    ranked = h.withColumn("mrn", F.row_number().over(w_metric)).filter(F.col("mrn") <= window_rows)
    per_metric = ranked.groupBy(F.col("version_model_type").alias("model_type"), "metric_name").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.max(F.when(F.col("mrn") == 1, F.col("metric_value"))).alias("recent"),
        F.avg(F.when(F.col("mrn") > 1, F.col("metric_value"))).alias("average_older"))
    change = abs_relative_change("recent", "average_older")
    valid = F.col("n_values") >= 2
    return per_metric.select(
        "model_type", "metric_name", "n_values", "recent", "average_older",
        F.when(valid, change).alias("percent_change"),
        F.coalesce(valid & (change > F.lit(threshold)), F.lit(False)).alias("drift_detected"))


def drift_details(history: DataFrame, versions: DataFrame, as_of: str | None = None, **options) -> DataFrame:
    """L11's drift part: the drifted metrics of each model type with their figures."""
    return prediction_drift(history, versions, **options).where("drift_detected").select(
        "model_type", "metric_name", "recent", "average_older", "percent_change",
        as_of_lit(as_of).alias("report_timestamp"))


def drift_by_type(drift: DataFrame, domain: DataFrame) -> DataFrame:
    d = drift.groupBy("model_type").agg(F.max(F.col("drift_detected").cast("int")).alias("d"))
    return domain.join(d, "model_type", "left").select(
        "model_type", F.coalesce(F.col("d") == 1, F.lit(False)).alias("drift_detected"))


def model_staleness(versions: DataFrame, deployments: DataFrame, as_of: str | None = None,
                    max_days: int = MAX_DAYS_WITHOUT_TRAINING, active: DataFrame | None = None,
                    domain: DataFrame | None = None) -> DataFrame:
    """Whole days since the active version was created, stale when > 7."""
    domain = domain if domain is not None else model_type_domain(versions, deployments)
    active = active if active is not None else active_versions(versions, deployments)
    act = active.select(
        "model_type", F.col("id").alias("active_version_id"), F.col("created_at").alias("active_created_at"))
    j = domain.join(act, "model_type", "left")
    days = whole_days(F.col("active_created_at"), as_of_lit(as_of))
    stale = F.coalesce(days > F.lit(max_days), F.lit(False))
    msg = (F.when(F.col("active_version_id").isNull(), F.lit("No active model found"))
           .when(F.col("active_created_at").isNull(), F.lit("Model creation date unknown"))
           .when(stale, F.concat(F.lit("Model "), F.col("model_type"), F.lit(" is "), days.cast("string"),
                                 F.lit(f" days old (max: {max_days})")))
           .otherwise(F.concat(F.lit("Model is "), days.cast("string"), F.lit(" days old (acceptable)"))))
    return j.select("model_type", "active_version_id", days.alias("days_old"), stale.alias("is_stale"),
                    msg.alias("message"))


def metric_degradation(versions: DataFrame, deployments: DataFrame, metrics: DataFrame,
                       metric_name: str = DEGRADATION_METRIC,
                       threshold: float = DEGRADATION_THRESHOLD, active: DataFrame | None = None,
                       domain: DataFrame | None = None) -> DataFrame:
    """Latest test value of ``metric_name`` of the active version < 0.80.

    The metrics log is cut to the active versions (semi join) and to the one
    metric before the latest-value aggregation."""
    domain = domain if domain is not None else model_type_domain(versions, deployments)
    active = active if active is not None else active_versions(versions, deployments)
    act = active.select("model_type", F.col("id").alias("active_version_id"))
    relevant = metrics_of(metrics.where(F.col("metric_name") == metric_name), active.select("id"))
    m = latest_version_metrics(relevant, "test").select(
        F.col("model_version_id").alias("active_version_id"), F.col("metric_value").alias("value"))
    j = domain.join(act, "model_type", "left").join(m, "active_version_id", "left")
    degraded = F.coalesce(F.col("value") < F.lit(threshold), F.lit(False))
    reason = (F.when(F.col("active_version_id").isNull(), F.lit("no_active_version"))
              .when(F.col("value").isNull(), F.lit(f"metric_{metric_name}_not_found"))
              .otherwise(F.lit(None).cast("string")))
    return j.select("model_type", "active_version_id", F.lit(metric_name).alias("metric"), "value",
                    F.lit(threshold).alias("threshold"), degraded.alias("is_degraded"), reason.alias("reason"))


def health_report(versions: DataFrame, deployments: DataFrame, metrics: DataFrame, history: DataFrame,
                  as_of: str | None = None) -> DataFrame:
    """Staleness, drift and degradation per model type; unhealthy if any.

    The model-type domain and the active versions (one row per type) are
    materialised once and shared by the three checks."""
    types = materialize(model_type_domain(versions, deployments).join(
        active_versions(versions, deployments), "model_type", "left"), "model_types")  # one row per type
    domain = types.select("model_type")
    active = types.where(F.col("id").isNotNull())
    st = model_staleness(versions, deployments, as_of, active=active, domain=domain).select(
        "model_type", "is_stale", F.col("message").alias("staleness_message"))
    dr = drift_by_type(prediction_drift(history, versions), domain)
    dg = metric_degradation(versions, deployments, metrics, active=active, domain=domain).select(
        "model_type", "is_degraded", F.col("value").alias("degradation_value"),
        F.col("threshold").alias("degradation_threshold"), F.col("metric").alias("degradation_metric"))
    j = st.join(dr, "model_type").join(dg, "model_type")
    bad = F.col("is_stale") | F.col("drift_detected") | F.col("is_degraded")
    return j.select("*", F.when(bad, F.lit("unhealthy")).otherwise(F.lit("healthy")).alias("overall_health"),
                    as_of_lit(as_of).alias("report_timestamp"))


def health_alerts(report: DataFrame) -> DataFrame:
    """Alert text for unhealthy model types, parts joined by " | "."""
    text = F.concat_ws(
        " | ",
        F.when(F.col("is_stale"), F.concat(F.lit("STALENESS: "), F.col("staleness_message"))),
        F.when(F.col("drift_detected"), F.lit("DRIFT: Prediction distribution has changed significantly")),
        F.when(F.col("is_degraded"), F.concat(
            F.lit("DEGRADATION: "), F.col("degradation_metric"), F.lit(" is "), percent_2dp("degradation_value"),
            F.lit(" (threshold: "), percent_2dp("degradation_threshold"), F.lit(")"))))
    return report.where(F.col("overall_health") == "unhealthy").select("model_type", text.alias("alert"))


def data_freshness_log(decisions: DataFrame, as_of: str | None = None) -> DataFrame:
    """S5 (L3's log): the rows a retrain check appends, every column filled."""
    return decisions.where("logged").select(
        "model_type", as_of_lit(as_of).alias("check_timestamp"), "last_training_date", "latest_feedback_date",
        F.col("new_records").alias("new_feedback_count"), "percent_new_data", "decision_to_retrain", "reason")


def training_plan(decisions: DataFrame, next_versions: DataFrame, as_of: str | None = None,
                  models_dir: str = "models") -> DataFrame:
    """L3 + L6 + S5: the version rows a scheduled run would create -- one per
    model type whose retrain decision is positive, numbered by L6, with the
    artifact paths stored on the row (D7) and ``status='training'``."""
    todo = decisions.where("decision_to_retrain").select("model_type", "reason")
    nv = next_versions.select("model_type", "next_version")
    base = F.concat(F.lit(f"{models_dir.rstrip('/')}/"), F.col("model_type"), F.lit("_model_"), F.col("next_version"))
    return todo.join(nv, "model_type", "left").select(
        "model_type",
        F.coalesce("next_version", F.lit("v1")).alias("version"),
        F.lit("training").alias("status"),
        as_of_lit(as_of).alias("created_at"),
        F.coalesce(base, F.concat(F.lit(f"{models_dir.rstrip('/')}/"), F.col("model_type"), F.lit("_model_v1")))
        .alias("model_path"),
        F.concat(F.coalesce(base, F.concat(F.lit(f"{models_dir.rstrip('/')}/"), F.col("model_type"),
                                             F.lit("_model_v1"))), F.lit("_scaler")).alias("scaler_path"),
        F.col("reason").alias("description"))
