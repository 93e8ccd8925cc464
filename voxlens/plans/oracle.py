"""DuckDB oracle SQL for every registered query.

The driver registers only the base tables, so each query inlines the adapter
views and intermediate steps as leading CTEs. CTE bodies are defined once
here with their dependencies; ``build(final, *needs)`` emits the closure in
dependency order. All literals come from ``voxlens.config`` so the oracle and
the Spark plans share one set of fixed values.
"""

from __future__ import annotations

from voxlens.sources import adapters
from voxlens.config import (
    AREA_WEIGHTS,
    DEFAULT_AS_OF,
    LINEAR_CHURN_BIAS,
    LINEAR_CHURN_WEIGHTS,
    LOOKBACK_DAYS,
    TIER_CODES,
)

AS_OF = f"TIMESTAMP '{DEFAULT_AS_OF}'"


def days_before(n: int) -> str:
    return f"({AS_OF} - INTERVAL {int(n)} DAY)"


def whole_days(earlier: str, later: str = AS_OF) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000) AS BIGINT)"


def tier_code(c: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in TIER_CODES.items())
    return f"(CASE {c} {whens} ELSE 0 END)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


class LazySQL:
    """SQL text resolved on first use, so CTEs may be declared after the
    queries that reference them."""

    def __init__(self, final: str, needs: tuple[str, ...]):
        self.final, self.needs = final, needs

    def __str__(self) -> str:
        return _resolve(self.final, *self.needs)


def build(final: str, *needs: str) -> LazySQL:
    return LazySQL(final, needs)


def _resolve(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + final


# ----------------------------------------------------------------- adapters
cte("feedback_enriched", """
SELECT 'fb-' || CAST(e.event_id AS STRING) AS id,
  e.ts - INTERVAL '1' DAY * (e.event_id % 120) AS created_at,
  CASE e.event_id % 6 WHEN 0 THEN 'zendesk' WHEN 1 THEN 'nps_survey' WHEN 2 THEN 'google_play'
    WHEN 3 THEN 'app_store' WHEN 4 THEN 'email' ELSE 'chat' END AS source,
  CASE CAST(regexp_extract(e.props,'[0-9]+',0) AS INT) % 8 WHEN 0 THEN 'billing' WHEN 1 THEN 'onboarding'
    WHEN 2 THEN 'performance' WHEN 3 THEN 'features' WHEN 4 THEN 'security' WHEN 5 THEN 'ui_ux'
    WHEN 6 THEN 'integrations' ELSE 'support' END AS product_area,
  CASE e.event_type WHEN 'error' THEN 'negative' WHEN 'purchase' THEN 'positive'
    WHEN 'signup' THEN 'positive' ELSE 'neutral' END AS sentiment,
  CASE WHEN e.value < 10 THEN 1 WHEN e.value < 25 THEN 2 WHEN e.value < 50 THEN 3
    WHEN e.value < 90 THEN 4 ELSE 5 END AS priority,
  't' || CAST(CAST(regexp_extract(e.props,'[0-9]+',0) AS INT) AS STRING) AS topic,
  CASE WHEN e.user_id % 29 = 7 THEN NULL ELSE r.r_name END AS region,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'enterprise' WHEN 'BUILDING' THEN 'pro'
    WHEN 'FURNITURE' THEN 'pro' WHEN 'HOUSEHOLD' THEN 'free' ELSE 'trial' END AS customer_tier,
  e.event_type || ' ' || e.props AS summary,
  e.user_id AS user_id
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("model_versions", """
SELECT o_orderkey AS id,
  CASE o_custkey % 20 WHEN 0 THEN 'churn' WHEN 1 THEN 'product_area'
    ELSE 'm' || CAST(o_custkey % 20 AS STRING) END AS model_type,
  CASE WHEN o_orderkey % 3 = 0 THEN 'v' || CAST(o_orderkey AS STRING) || '.1'
    ELSE 'v' || CAST(o_orderkey AS STRING) END AS version,
  'inactive' AS status,
  o_orderdate + INTERVAL '1' DAY * (8215 - 3 * (o_custkey % 20)) AS created_at,
  '{"lookback_days": "' || CAST(30 + o_orderkey % 61 AS STRING) || '", "epochs": "50"}' AS hyperparameters
FROM orders""")

cte("model_metrics", """
SELECT l_orderkey AS model_version_id,
  CASE l_linenumber % 5 WHEN 0 THEN 'accuracy' WHEN 1 THEN 'precision' WHEN 2 THEN 'recall'
    WHEN 3 THEN 'f1' ELSE 'auc' END AS metric_name,
  0.5 + l_discount * 4 AS metric_value,
  CASE l_returnflag WHEN 'N' THEN 'validation' ELSE 'test' END AS dataset_type,
  l_shipdate AS created_at
FROM lineitem""")

cte("model_deployments", """
SELECT model_type, id AS active_version_id FROM (
  SELECT model_type, id, row_number() OVER (PARTITION BY model_type ORDER BY created_at DESC, id DESC) AS rn
  FROM model_versions) t WHERE rn = 2""", "model_versions")

cte("prediction_distribution_history", """
SELECT e.event_id AS id, v.model_type, v.id AS model_version_id,
  CASE e.event_id % 2 WHEN 0 THEN 'prediction_mean' ELSE 'prediction_std' END AS metric_name,
  e.value AS metric_value, e.ts AS scoring_date
FROM events e JOIN model_versions v ON e.event_id = v.id""", "model_versions")

# ----------------------------------------------------------------- features
cte("fb_lookback", f"""
SELECT * FROM feedback_enriched WHERE created_at >= {days_before(LOOKBACK_DAYS)}""", "feedback_enriched")


def _account_base(grain: str, src: str = "fb_lookback") -> str:
    keys = "customer_tier, region" if grain == "tier" else "user_id, customer_tier, region"
    acct = "customer_tier" if grain == "tier" else "CAST(user_id AS STRING)"
    return f"""
SELECT {acct} AS account_id, {keys},
  COUNT(*) AS total_feedback,
  COUNT(*) FILTER (WHERE created_at > {days_before(30)}) AS feedback_last_30d,
  COUNT(*) FILTER (WHERE created_at > {days_before(7)}) AS feedback_last_7d,
  COUNT(*) FILTER (WHERE sentiment = 'negative') AS negative_feedback,
  COUNT(*) FILTER (WHERE sentiment = 'positive') AS positive_feedback,
  COUNT(*) FILTER (WHERE sentiment = 'neutral') AS neutral_feedback,
  COUNT(*) FILTER (WHERE priority >= 4) AS critical_issues,
  COUNT(*) FILTER (WHERE priority = 5) AS p5_issues,
  AVG(priority) AS avg_priority,
  MAX(created_at) AS last_feedback_date,
  COUNT(DISTINCT product_area) AS product_areas_mentioned,
  COUNT(*) FILTER (WHERE product_area = 'billing') AS billing_issues,
  COUNT(*) FILTER (WHERE product_area = 'performance') AS performance_issues,
  COUNT(*) FILTER (WHERE product_area = 'security') AS security_issues
FROM {src}
GROUP BY {keys}"""


def _account_features(base: str) -> str:
    return f"""
SELECT b.*,
  negative_feedback / (total_feedback + 1) AS negative_ratio,
  positive_feedback / (total_feedback + 1) AS positive_ratio,
  critical_issues / (total_feedback + 1) AS critical_ratio,
  {whole_days('last_feedback_date')} AS days_since_last_feedback,
  feedback_last_7d / (feedback_last_30d + 1) AS feedback_velocity,
  CAST(billing_issues > 0 AS INTEGER) AS billing_issue_flag,
  {tier_code('customer_tier')} AS tier_encoded,
  COALESCE(rc.region_encoded, -1) AS region_encoded
FROM {base} b
LEFT JOIN (SELECT region, CAST(row_number() OVER (ORDER BY region) - 1 AS INTEGER) AS region_encoded
           FROM (SELECT DISTINCT region FROM {base} WHERE region IS NOT NULL) d) rc
  ON b.region = rc.region"""


cte("acct_base_tier", _account_base("tier"), "fb_lookback")
cte("acct_base_user", _account_base("user"), "fb_lookback")
cte("acct_features_tier", _account_features("acct_base_tier"), "acct_base_tier")
cte("acct_features_user", _account_features("acct_base_user"), "acct_base_user")

ACCOUNT_MATRIX_COLS = ("total_feedback, feedback_last_30d, feedback_last_7d, negative_feedback, "
                       "positive_feedback, critical_issues, p5_issues, avg_priority, product_areas_mentioned, "
                       "billing_issues, performance_issues, security_issues, negative_ratio, positive_ratio, "
                       "critical_ratio, days_since_last_feedback, feedback_velocity, billing_issue_flag, "
                       "region_encoded, tier_encoded").split(", ")

cte("area_base", f"""
SELECT product_area, customer_tier AS segment,
  COUNT(*) AS feedback_count,
  COUNT(*) FILTER (WHERE created_at > {days_before(30)}) AS feedback_last_30d,
  COUNT(*) FILTER (WHERE created_at > {days_before(7)}) AS feedback_last_7d,
  COUNT(*) FILTER (WHERE sentiment = 'negative') AS negative_count,
  COUNT(*) FILTER (WHERE sentiment = 'positive') AS positive_count,
  COUNT(*) FILTER (WHERE sentiment = 'neutral') AS neutral_count,
  COUNT(*) FILTER (WHERE priority >= 4) AS critical_count,
  COUNT(*) FILTER (WHERE priority = 5) AS p5_count,
  AVG(priority) AS avg_priority,
  MAX(created_at) AS last_feedback_date,
  COUNT(DISTINCT topic) AS unique_topics,
  COUNT(DISTINCT region) AS regions_affected
FROM fb_lookback
GROUP BY product_area, customer_tier""", "fb_lookback")


def _area_features(base: str) -> str:
    return f"""
SELECT b.*,
  negative_count / (feedback_count + 1) AS negative_ratio,
  critical_count / (feedback_count + 1) AS critical_ratio,
  p5_count / (feedback_count + 1) AS p5_ratio,
  (positive_count - negative_count) / (feedback_count + 1) AS sentiment_score,
  (positive_count - negative_count) / (feedback_count + 1) AS avg_sentiment_score,
  feedback_last_7d / (feedback_last_30d + 1) AS recent_activity_ratio,
  {tier_code('segment')} AS segment_encoded,
  CAST(COALESCE(segment = 'enterprise', FALSE) AS INTEGER) AS enterprise_flag
FROM {base} b"""


cte("area_features", _area_features("area_base"), "area_base")

NORM_COLS = [c for _, c, _ in AREA_WEIGHTS if c != "enterprise_flag"]


def _area_norm(src: str) -> str:
    stats = ", ".join(f"MIN({c}) AS min_{c}, MAX({c}) AS max_{c}" for c in NORM_COLS)
    norms = ",\n  ".join(
        f"CASE WHEN s.max_{c} = s.min_{c} THEN 0.5 ELSE CAST(f.{c} - s.min_{c} AS DOUBLE) / (s.max_{c} - s.min_{c}) END AS norm_{c}"
        for c in NORM_COLS)
    return f"""
SELECT f.*,
  {norms}
FROM {src} f CROSS JOIN (SELECT {stats} FROM {src}) s"""


def _area_score_expr(weights: dict | None = None) -> str:
    terms = []
    for name, c, default in AREA_WEIGHTS:
        w = (weights or {}).get(name, default)
        x = c if c == "enterprise_flag" else f"norm_{c}"
        terms.append(f"{x} * CAST({w!r} AS DOUBLE) * 100")
    return " + ".join(terms)


def area_bin_sql(x: str, include_lowest: bool = True) -> str:
    first = f"{x} >= 0" if include_lowest else f"{x} > 0"
    return (f"CASE WHEN isnan({x}) THEN NULL WHEN {first} AND {x} <= 30 THEN 'low' "
            f"WHEN {x} > 30 AND {x} <= 50 THEN 'medium' WHEN {x} > 50 AND {x} <= 70 THEN 'high' "
            f"WHEN {x} > 70 AND {x} <= 100 THEN 'critical' ELSE NULL END")


cte("area_norm", _area_norm("area_features"), "area_features")
cte("area_scored", f"""
SELECT *, {area_bin_sql('priority_score', True)} AS risk_category
FROM (SELECT *, {_area_score_expr()} AS priority_score FROM area_norm) t""", "area_norm")

cte("product_area_impact", f"""
SELECT product_area, segment, priority_score, feedback_count, avg_sentiment_score,
  negative_count, critical_count, {AS_OF} AS predicted_at, 'v1' AS model_version
FROM area_scored""", "area_scored")


# ----------------------------------------------------------------- account scoring
def _standardize(src: str, cols=ACCOUNT_MATRIX_COLS, keys=("account_id",)) -> str:
    stats = ", ".join(f"AVG({c}) AS mean_{c}, stddev_pop({c}) AS std_{c}" for c in cols)
    z = ",\n  ".join(
        f"(m.{c} - s.mean_{c}) / (CASE WHEN s.std_{c} IS NULL OR s.std_{c} < 1e-12 THEN 1.0 ELSE s.std_{c} END) AS {c}"
        for c in cols)
    mcols = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in cols)
    k = ", ".join(keys)
    mk = ", ".join(f"m.{c}" for c in keys)
    return f"""
SELECT {mk},
  {z}
FROM (SELECT {k}, {mcols} FROM {src}) m
CROSS JOIN (SELECT {stats} FROM (SELECT {mcols} FROM {src}) x) s"""


def _logit_expr() -> str:
    expr = f"CAST({LINEAR_CHURN_BIAS!r} AS DOUBLE)"
    for c, w in LINEAR_CHURN_WEIGHTS.items():
        expr = f"{expr} + CAST({w!r} AS DOUBLE) * {c}"
    return expr


def churn_bucket_sql(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN NULL WHEN NOT isnan({p}) AND {p} < 0.25 THEN 'low' "
            f"WHEN NOT isnan({p}) AND {p} < 0.5 THEN 'medium' WHEN NOT isnan({p}) AND {p} < 0.75 THEN 'high' "
            f"ELSE 'critical' END")


cte("acct_scaled_user", _standardize("acct_features_user"), "acct_features_user")
cte("acct_linear_user", f"""
SELECT account_id, logit, 1.0 / (1.0 + exp(-logit)) AS churn_probability
FROM (SELECT account_id, {_logit_expr()} AS logit FROM acct_scaled_user) t""", "acct_scaled_user")
cte("account_risk_scores", f"""
SELECT account_id, churn_probability, (1.0 - churn_probability) * 100 AS health_score,
  {churn_bucket_sql('churn_probability')} AS risk_category,
  {AS_OF} AS predicted_at, 'v1' AS model_version
FROM acct_linear_user""", "acct_linear_user")


# ----------------------------------------------------------------- learning
def keyed_uniform(key: str, salt: str, start: int = 1) -> str:
    return (f"((CAST('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), {start}, 8) AS BIGINT) + 0.5)"
            f" / CAST(4294967296 AS DOUBLE))")


def keyed_normal(key: str, salt: str, sd: float) -> str:
    u1, u2 = keyed_uniform(key, salt, 1), keyed_uniform(key, salt, 9)
    return f"(CAST({sd!r} AS DOUBLE) * sqrt(-2.0 * ln({u1})) * cos({2.0 * 3.141592653589793!r} * {u2}))"


cte("labels_user", f"""
SELECT *, CAST((churn_prob + noise) > 0.5 AS INTEGER) AS churned
FROM (SELECT *, 1.0 / (1.0 + exp(-5.0 * (churn_score - 0.5))) AS churn_prob,
             {keyed_normal('account_id', 'label', 0.1)} AS noise
      FROM (SELECT *, negative_ratio * 0.4 + critical_ratio * 0.3 + billing_issue_flag * 0.2
                      + days_since_last_feedback / 90.0 * 0.1 AS churn_score
            FROM acct_features_user) a) b""", "acct_features_user")
cte("class_balance", """
SELECT n, positives, n - positives AS negatives, least(positives, n - positives) AS minority,
  CAST(0.8 AS DOUBLE) AS test_size
FROM (SELECT COUNT(*) AS n, CAST(COALESCE(SUM(churned), 0) AS BIGINT) AS positives FROM labels_user) t""",
    "labels_user")
cte("split_user", f"""
SELECT l.*, {keyed_uniform('l.account_id', 'split')} < cb.test_size AS is_test
FROM labels_user l CROSS JOIN class_balance cb""", "labels_user", "class_balance")
cte("test_preds", """
SELECT s.account_id, s.churned, p.churn_probability
FROM split_user s JOIN acct_linear_user p ON s.account_id = p.account_id
WHERE s.is_test""", "split_user", "acct_linear_user")
cte("auc", """
SELECT CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0
            THEN SUM(pos * (neg_below + neg * 0.5)) / (SUM(pos) * SUM(neg)) END AS auc
FROM (SELECT s, pos, neg,
        COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
      FROM (SELECT churn_probability AS s, COUNT(*) FILTER (WHERE churned = 1) AS pos,
                   COUNT(*) FILTER (WHERE churned = 0) AS neg
            FROM test_preds GROUP BY churn_probability) g) c""", "test_preds")

# ----------------------------------------------------------------- registry
cte("latest_metrics", """
SELECT model_version_id, dataset_type, metric_name, metric_value, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY model_version_id, dataset_type, metric_name
                               ORDER BY created_at DESC, metric_value DESC) AS rn
  FROM model_metrics) t WHERE rn = 1""", "model_metrics")
cte("ranked_versions", """
SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY created_at DESC, id DESC) AS rn
FROM model_versions""", "model_versions")
cte("active_versions", """
SELECT v.id, d.model_type, v.version, v.status, v.created_at, v.hyperparameters
FROM model_versions v JOIN model_deployments d ON v.id = d.active_version_id""",
    "model_versions", "model_deployments")
cte("type_domain", """
SELECT DISTINCT model_type FROM (SELECT model_type FROM model_versions
                                 UNION ALL SELECT model_type FROM model_deployments) u""",
    "model_versions", "model_deployments")
cte("pairs", """
SELECT n.model_type, n.id AS new_version_id, d.active_version_id AS previous_version_id
FROM (SELECT model_type, id FROM ranked_versions WHERE rn = 1) n
LEFT JOIN model_deployments d ON n.model_type = d.model_type""", "ranked_versions", "model_deployments")
cte("improvements", """
SELECT j.model_type, p.previous_version_id, p.new_version_id, j.metric_name,
  COALESCE(j.prev_value, 0.0) AS prev_value, COALESCE(j.new_value, 0.0) AS new_value,
  CASE WHEN COALESCE(j.prev_value, 0.0) > 0
       THEN (COALESCE(j.new_value, 0.0) - COALESCE(j.prev_value, 0.0)) / COALESCE(j.prev_value, 0.0)
       ELSE COALESCE(j.new_value, 0.0) END AS improvement
FROM (
  SELECT COALESCE(a.model_type, b.model_type) AS model_type, COALESCE(a.metric_name, b.metric_name) AS metric_name,
         a.prev_value, b.new_value
  FROM (SELECT p.model_type, m.metric_name, m.metric_value AS prev_value
        FROM pairs p JOIN latest_metrics m ON m.model_version_id = p.previous_version_id AND m.dataset_type = 'test'
        WHERE p.previous_version_id IS NOT NULL) a
  FULL OUTER JOIN
       (SELECT p.model_type, m.metric_name, m.metric_value AS new_value
        FROM pairs p JOIN latest_metrics m ON m.model_version_id = p.new_version_id AND m.dataset_type = 'test'
        WHERE p.previous_version_id IS NOT NULL) b
  ON a.model_type = b.model_type AND a.metric_name = b.metric_name) j
JOIN pairs p ON j.model_type = p.model_type""", "pairs", "latest_metrics")
cte("promotion", """
SELECT p.model_type, p.previous_version_id, p.new_version_id,
  CASE WHEN p.previous_version_id IS NULL THEN NULL ELSE COALESCE(i.avg_improvement, 0.0) END AS average_improvement,
  COALESCE(i.n_metrics, 0) AS n_metrics,
  (p.previous_version_id IS NULL OR COALESCE(i.avg_improvement, 0.0) > 0.01) AS promotion_recommended,
  CASE WHEN p.previous_version_id IS NULL THEN 'first_deployment'
       WHEN COALESCE(i.avg_improvement, 0.0) > 0.01 THEN 'improvement_above_threshold'
       ELSE 'improvement_below_threshold' END AS promotion_reason,
  CAST(0.01 AS DOUBLE) AS promotion_threshold
FROM pairs p LEFT JOIN (SELECT model_type, AVG(improvement) AS avg_improvement, COUNT(*) AS n_metrics
                        FROM improvements GROUP BY model_type) i ON p.model_type = i.model_type""",
    "pairs", "improvements")
cte("deployments_after", f"""
SELECT d.model_type,
  CASE WHEN pr.model_type IS NOT NULL THEN pr.new_version_id ELSE d.active_version_id END AS active_version_id,
  CASE WHEN pr.model_type IS NOT NULL THEN d.active_version_id ELSE CAST(NULL AS BIGINT) END AS previous_version_id,
  CASE WHEN pr.model_type IS NOT NULL THEN d.active_version_id IS NOT NULL ELSE FALSE END AS rollback_available,
  CASE WHEN pr.model_type IS NOT NULL THEN {AS_OF} ELSE CAST(NULL AS TIMESTAMP) END AS deployed_at
FROM model_deployments d
LEFT JOIN (SELECT model_type, new_version_id FROM promotion WHERE promotion_recommended) pr
  ON d.model_type = pr.model_type
UNION ALL
SELECT pr.model_type, pr.new_version_id, NULL, FALSE, {AS_OF}
FROM promotion pr
WHERE pr.promotion_recommended AND pr.model_type NOT IN (SELECT model_type FROM model_deployments)""",
    "model_deployments", "promotion")

# ----------------------------------------------------------------- monitoring
cte("drift", """
SELECT model_type, metric_name, n_values, recent, average_older,
  CASE WHEN n_values >= 2 THEN chg END AS percent_change,
  COALESCE(n_values >= 2 AND chg > 0.15, FALSE) AS drift_detected
FROM (SELECT *, CASE WHEN average_older <> 0 THEN abs((recent - average_older) / average_older) END AS chg
      FROM (SELECT version_model_type AS model_type, metric_name, COUNT(*) AS n_values,
                   MAX(CASE WHEN mrn = 1 THEN metric_value END) AS recent,
                   AVG(CASE WHEN mrn > 1 THEN metric_value END) AS average_older
            FROM (SELECT h.id, h.metric_name, h.metric_value, h.scoring_date, v.model_type AS version_model_type,
                         row_number() OVER (PARTITION BY v.model_type, h.metric_name
                                            ORDER BY h.scoring_date DESC, h.id DESC) AS mrn
                  FROM prediction_distribution_history h JOIN model_versions v ON h.model_version_id = v.id) z
            WHERE mrn <= 20
            GROUP BY version_model_type, metric_name) a) b""",
    "prediction_distribution_history", "model_versions")
cte("staleness", f"""
SELECT dm.model_type, a.id AS active_version_id, {whole_days('a.created_at')} AS days_old,
  COALESCE({whole_days('a.created_at')} > 7, FALSE) AS is_stale,
  CASE WHEN a.id IS NULL THEN 'No active model found'
       WHEN a.created_at IS NULL THEN 'Model creation date unknown'
       WHEN {whole_days('a.created_at')} > 7
         THEN 'Model ' || dm.model_type || ' is ' || CAST({whole_days('a.created_at')} AS VARCHAR) || ' days old (max: 7)'
       ELSE 'Model is ' || CAST({whole_days('a.created_at')} AS VARCHAR) || ' days old (acceptable)' END AS message
FROM type_domain dm LEFT JOIN active_versions a ON dm.model_type = a.model_type""",
    "type_domain", "active_versions")
cte("degradation", """
SELECT dm.model_type, a.id AS active_version_id, 'accuracy' AS metric, m.metric_value AS value,
  CAST(0.8 AS DOUBLE) AS threshold, COALESCE(m.metric_value < 0.8, FALSE) AS is_degraded,
  CASE WHEN a.id IS NULL THEN 'no_active_version'
       WHEN m.metric_value IS NULL THEN 'metric_accuracy_not_found' ELSE NULL END AS reason
FROM type_domain dm LEFT JOIN active_versions a ON dm.model_type = a.model_type
LEFT JOIN (SELECT model_version_id, metric_value FROM latest_metrics
           WHERE dataset_type = 'test' AND metric_name = 'accuracy') m ON m.model_version_id = a.id""",
    "type_domain", "active_versions", "latest_metrics")


def percent_2dp_sql(x: str) -> str:
    h = f"CAST(floor({x} * 10000 + 0.5) AS BIGINT)"
    return (f"(CAST(CAST(floor({h} / 100) AS BIGINT) AS VARCHAR) || '.' || "
            f"lpad(CAST({h} % 100 AS VARCHAR), 2, '0') || '%')")


def fixed_1dp_sql(x: str) -> str:
    t = f"CAST(floor({x} * 10 + 0.5) AS BIGINT)"
    return f"(CAST(CAST(floor({t} / 10) AS BIGINT) AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR))"


cte("health", f"""
SELECT s.model_type, s.is_stale, s.message AS staleness_message,
  COALESCE(dr.d, FALSE) AS drift_detected,
  g.is_degraded, g.value AS degradation_value, g.threshold AS degradation_threshold, g.metric AS degradation_metric,
  CASE WHEN s.is_stale OR COALESCE(dr.d, FALSE) OR g.is_degraded THEN 'unhealthy' ELSE 'healthy' END AS overall_health,
  {AS_OF} AS report_timestamp
FROM staleness s
LEFT JOIN (SELECT model_type, bool_or(drift_detected) AS d FROM drift GROUP BY model_type) dr
  ON s.model_type = dr.model_type
JOIN degradation g ON s.model_type = g.model_type""", "staleness", "drift", "degradation")


# ------------------------------------------------- logs of deployments and runs
cte("deployment_log", adapters.DEPLOYMENT_LOG_SQL, "model_versions")
cte("run_starts", adapters.RUN_STARTS_SQL, "model_versions")
cte("run_ends", adapters.RUN_ENDS_SQL, "model_versions")


def deployed_as_of(at: str) -> str:
    """The deployment that held at ``at``, by model type."""
    return f"""SELECT model_type, active_version_id, deployed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY deployed_at DESC, entry DESC) AS rn
  FROM deployment_log WHERE deployed_at <= TIMESTAMP '{at}') h WHERE rn = 1"""
