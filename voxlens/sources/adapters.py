"""Adapters that present the driver's test tables in the reference's shapes.

``feedback_enriched`` and the model-registry tables do not exist in the test
data; FIXTURES.md defines them as views over ``events``, ``customer``,
``nation``, ``region``, ``orders`` and ``lineitem``. They are written here as
DataFrame expressions so Catalyst can prune and push filters through them.
The DuckDB twin of each view lives in ``voxlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- FIXED VALUES
# Adapter mappings from FIXTURES.md (must match the oracle views exactly).
SOURCES_BY_MOD6 = ("zendesk", "nps_survey", "google_play", "app_store", "email", "chat")
AREAS_BY_MOD8 = ("billing", "onboarding", "performance", "features", "security", "ui_ux",
                 "integrations", "support")
SENTIMENT_BY_EVENT = {"error": "negative", "purchase": "positive", "signup": "positive"}
SENTIMENT_DEFAULT = "neutral"
PRIORITY_VALUE_EDGES = (10, 25, 50, 90)  # value < edge -> priority 1..4, else 5
TIER_BY_SEGMENT = {"AUTOMOBILE": "enterprise", "BUILDING": "pro", "FURNITURE": "pro",
                   "HOUSEHOLD": "free"}
TIER_DEFAULT = "trial"
NULL_REGION_MOD, NULL_REGION_REM = 29, 7
SPREAD_DAYS_MOD = 120
MODEL_TYPE_MOD = 20
MODEL_TYPE_NAMES = {0: "churn", 1: "product_area"}
VERSION_DAY_SHIFT, VERSION_DAY_STAGGER = 8215, 3
METRIC_BY_LINE_MOD5 = ("accuracy", "precision", "recall", "f1", "auc")
# ------------------------------------------------------------ END FIXED VALUES


def _case_index(expr: str, values) -> str:
    """``CASE expr WHEN 0 THEN values[0] ... ELSE values[-1] END`` as SQL text."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {whens} ELSE '{values[-1]}' END"


def _case_map(expr: str, mapping, default_sql: str) -> str:
    whens = " ".join(f"WHEN {k!r} THEN '{v}'" if isinstance(k, str) else f"WHEN {k} THEN '{v}'"
                     for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default_sql} END"


def customer_dimension(t) -> DataFrame:
    """customer -> (c_custkey, c_mktsegment, r_name).

    nation and region are fixed-size dimension tables (25 and 5 rows by the
    TPC-H definition), so broadcasting them is bounded; customer grows with
    the data and is joined to the facts by key without a hint. The join is
    left plain (no grouping or repartition in between) so that AQE can split
    a hot ``user_id`` partition: its skew-join rule only applies when both
    join inputs come straight from planner-inserted shuffles.
    """
    geo = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    geo = geo.select("n_nationkey", "r_name")
    cust = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (cust.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "c_mktsegment", "r_name"))


_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


def _core_exprs() -> list[str]:
    priority = " ".join(f"WHEN value < {edge} THEN {i}" for i, edge in enumerate(PRIORITY_VALUE_EDGES, start=1))
    return [
        "'fb-' || CAST(event_id AS STRING) AS id",
        f"ts - INTERVAL '1' DAY * (event_id % {SPREAD_DAYS_MOD}) AS created_at",
        f"{_case_index(f'event_id % {len(SOURCES_BY_MOD6)}', SOURCES_BY_MOD6)} AS source",
        f"{_case_index(f'{_K} % {len(AREAS_BY_MOD8)}', AREAS_BY_MOD8)} AS product_area",
        f"{_case_map('event_type', SENTIMENT_BY_EVENT, repr(SENTIMENT_DEFAULT))} AS sentiment",
        f"CASE {priority} ELSE {len(PRIORITY_VALUE_EDGES) + 1} END AS priority",
        f"'t' || CAST({_K} AS STRING) AS topic",
    ]


def feedback_core(t) -> DataFrame:
    """The feedback facts without the customer attributes (``region``,
    ``customer_tier``): the same rows as ``feedback_enriched`` (a left join on
    a unique key never changes them) for reads that need no customer column,
    which then skip the fact-side join and its shuffle."""
    return t.events.selectExpr(*_core_exprs(), "event_type || ' ' || props AS summary", "user_id")


def feedback_enriched(t) -> DataFrame:
    """The feedback fact table (one row per feedback item).

    The event-derived columns are computed *before* the customer join, so
    the join's shuffle carries only the derived columns a query keeps after
    pruning (not the raw ``props`` text). Projections are SQL expression text:
    one parse on the JVM instead of a remote call per expression node.
    """
    core = feedback_core(t)
    fact = core.join(customer_dimension(t), F.col("user_id") == F.col("c_custkey"), "left")
    return fact.selectExpr(
        "id", "created_at", "source", "product_area", "sentiment", "priority", "topic",
        f"CASE WHEN user_id % {NULL_REGION_MOD} = {NULL_REGION_REM} THEN CAST(NULL AS STRING) ELSE r_name END AS region",
        f"{_case_map('c_mktsegment', TIER_BY_SEGMENT, repr(TIER_DEFAULT))} AS customer_tier",
        "summary", "user_id",
    )


def model_versions(t) -> DataFrame:
    mt = f"(o_custkey % {MODEL_TYPE_MOD})"
    return t.orders.selectExpr(
        "o_orderkey AS id",
        _case_map(mt, MODEL_TYPE_NAMES, "'m' || CAST(" + mt + " AS STRING)") + " AS model_type",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'v' || CAST(o_orderkey AS STRING) || '.1' "
        "ELSE 'v' || CAST(o_orderkey AS STRING) END AS version",
        "'inactive' AS status",
        f"o_orderdate + INTERVAL '1' DAY * ({VERSION_DAY_SHIFT} - {VERSION_DAY_STAGGER} * {mt}) AS created_at",
        "'{\"lookback_days\": \"' || CAST(30 + o_orderkey % 61 AS STRING) || '\", \"epochs\": \"50\"}' "
        "AS hyperparameters",
    )


def model_metrics(t) -> DataFrame:
    return t.lineitem.selectExpr(
        "l_orderkey AS model_version_id",
        f"{_case_index('l_linenumber % 5', METRIC_BY_LINE_MOD5)} AS metric_name",
        "0.5 + l_discount * 4 AS metric_value",
        "CASE l_returnflag WHEN 'N' THEN 'validation' ELSE 'test' END AS dataset_type",
        "l_shipdate AS created_at",
    )


def model_deployments(t) -> DataFrame:
    """Active version = second newest of each model type.

    ``rn = 2`` over a per-type window is planned with a window-group limit on
    both sides of the shuffle, so each map task ships at most two rows per type.
    """
    v = t.model_versions.select("model_type", "id", "created_at")
    w = Window.partitionBy("model_type").orderBy(F.col("created_at").desc(), F.col("id").desc())
    return (v.withColumn("rn", F.row_number().over(w)).filter("rn = 2")
            .select("model_type", F.col("id").alias("active_version_id")))


def prediction_distribution_history(t) -> DataFrame:
    e = t.events.select("event_id", "value", "ts")
    v = t.model_versions.select("id", "model_type")
    return e.join(v, F.col("event_id") == F.col("id"), "inner").select(
        F.col("event_id").alias("id"),
        "model_type",
        F.col("id").alias("model_version_id"),
        F.when(F.col("event_id") % 2 == 0, "prediction_mean").otherwise("prediction_std").alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.col("ts").alias("scoring_date"),
    )


# Stand-ins for the job logs (SQL text that both engines read): every version is deployed a day
# after it was made, each fifth again nine days later; a run per version, of which each seventh
# has not ended and each eleventh of the others has failed.
DEPLOYMENT_LOG_SQL = """
SELECT model_type, id AS active_version_id, created_at + INTERVAL '1' DAY AS deployed_at, id AS entry FROM model_versions
UNION ALL
SELECT model_type, id, created_at + INTERVAL '10' DAY, 1000000000000 + id FROM model_versions WHERE id % 5 = 0"""
RUN_STARTS_SQL = """
SELECT id AS run_id, id AS model_version_id, model_type, CASE WHEN id % 2 = 0 THEN 'scheduled' ELSE 'manual' END
  AS triggered_by, created_at AS started_at FROM model_versions"""
RUN_ENDS_SQL = """
SELECT id AS run_id, CASE WHEN id % 11 = 0 THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN id % 11 = 0 THEN 0 ELSE 10 + id % 90 END AS training_samples,
  CASE WHEN id % 11 = 0 THEN 0 ELSE 5 + id % 7 END AS test_samples,
  CASE WHEN id % 11 = 0 THEN 'RuntimeError: run ' || CAST(id AS STRING) END AS error_message,
  created_at + INTERVAL '1' HOUR AS completed_at FROM model_versions WHERE id % 7 <> 0"""


def _over_versions(t, sql: str) -> DataFrame:
    return t.spark.sql(sql.replace("FROM model_versions", "FROM {versions}"), versions=t.model_versions)


def deployment_log(t) -> DataFrame:
    return _over_versions(t, DEPLOYMENT_LOG_SQL)


def run_starts(t) -> DataFrame:
    return _over_versions(t, RUN_STARTS_SQL)


def run_ends(t) -> DataFrame:
    return _over_versions(t, RUN_ENDS_SQL)
