"""Query registrations. Each pairs a Spark plan with its
DuckDB twin from ``voxlens.plans.oracle``."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxlens.operators import buckets as bk
from voxlens.operators import daily
from voxlens.operators import features as feat
from voxlens.operators import id_index as idx
from voxlens.operators import learn as ln
from voxlens.operators import monitor as mon
from voxlens.operators import registry as reg
from voxlens.operators import reports as rp
from voxlens.operators import scoring as sc
from voxlens.operators import sinks as sk
from voxlens.plans import jobs
from voxlens.plans import oracle as O
from voxlens.plans.catalog import REGISTRY, register, round6

FEEDBACK_COLS = ("id, created_at, source, product_area, sentiment, priority, topic, region, "
                 "customer_tier, summary, user_id")
ACCT_BASE_COLS = ("account_id, customer_tier, region, total_feedback, feedback_last_30d, feedback_last_7d, "
                  "negative_feedback, positive_feedback, neutral_feedback, critical_issues, p5_issues, "
                  "avg_priority, last_feedback_date, product_areas_mentioned, billing_issues, "
                  "performance_issues, security_issues")
ACCT_DERIVED_COLS = ("negative_ratio, positive_ratio, critical_ratio, days_since_last_feedback, "
                     "feedback_velocity, billing_issue_flag, tier_encoded, region_encoded")
AREA_BASE_COLS = ("product_area, segment, feedback_count, feedback_last_30d, feedback_last_7d, negative_count, "
                  "positive_count, neutral_count, critical_count, p5_count, avg_priority, last_feedback_date, "
                  "unique_topics, regions_affected")
AREA_DERIVED_COLS = ("negative_ratio, critical_ratio, p5_ratio, sentiment_score, avg_sentiment_score, "
                     "recent_activity_ratio, segment_encoded, enterprise_flag")


def _cols(s: str) -> list[str]:
    return [c.strip() for c in s.split(",")]


# ------------------------------------------------------------------ S1, P1
@register("feedback_scan", O.build(f"SELECT {FEEDBACK_COLS} FROM feedback_enriched", "feedback_enriched"))
def feedback_scan(t):
    """The feedback fact table."""
    return t.feedback


@register("feedback_lookback", O.build(f"SELECT {FEEDBACK_COLS} FROM fb_lookback", "fb_lookback"))
def feedback_lookback(t):
    """Rows inside the 90-day lookback (inclusive cutoff)."""
    return feat.lookback(t.feedback)


# ------------------------------------------------------------------ A1, A2, X1-X5, W7
@register("acct_base_features", O.build(f"SELECT {ACCT_BASE_COLS} FROM acct_base_tier", "acct_base_tier"))
def acct_base_features(t):
    """A1 at the reference grain (customer_tier, region)."""
    return feat.account_base_features(t.feedback, grain="tier").select(*_cols(ACCT_BASE_COLS))


@register("acct_base_features_user",
          O.build(f"SELECT user_id, {ACCT_BASE_COLS} FROM acct_base_user", "acct_base_user"))
def acct_base_features_user(t):
    """A1 at the per-user grain."""
    return feat.account_base_features(t.feedback, grain="user").select("user_id", *_cols(ACCT_BASE_COLS))


@register("acct_features",
          O.build(f"SELECT {ACCT_BASE_COLS}, {ACCT_DERIVED_COLS} FROM acct_features_tier", "acct_features_tier"))
def acct_features(t):
    """A1 + X1-X5 + W7 (tier grain)."""
    return feat.account_features(t.feedback, grain="tier").select(*_cols(ACCT_BASE_COLS), *_cols(ACCT_DERIVED_COLS))


@register("acct_features_user",
          O.build(f"SELECT user_id, {ACCT_BASE_COLS}, {ACCT_DERIVED_COLS} FROM acct_features_user",
                  "acct_features_user"))
def acct_features_user(t):
    """A1 + X1-X5 + W7 (per-user grain)."""
    return feat.account_features(t.feedback, grain="user").select(
        "user_id", *_cols(ACCT_BASE_COLS), *_cols(ACCT_DERIVED_COLS))


@register("region_codes", O.build("""
SELECT region, CAST(row_number() OVER (ORDER BY region) - 1 AS INTEGER) AS region_encoded
FROM (SELECT DISTINCT region FROM acct_base_tier WHERE region IS NOT NULL) d""", "acct_base_tier"))
def region_codes(t):
    """Region code table of the account feature frame."""
    return feat.region_codes(feat.account_base_features(t.feedback, grain="tier"))


@register("area_base_features", O.build(f"SELECT {AREA_BASE_COLS} FROM area_base", "area_base"))
def area_base_features(t):
    """A2 by (product_area, segment)."""
    return feat.area_base_features(t.feedback).select(*_cols(AREA_BASE_COLS))


@register("area_features",
          O.build(f"SELECT {AREA_BASE_COLS}, {AREA_DERIVED_COLS} FROM area_features", "area_features"))
def area_features(t):
    """A2 + X1, X2, X4, X5."""
    return feat.area_features(t.feedback).select(*_cols(AREA_BASE_COLS), *_cols(AREA_DERIVED_COLS))


# ------------------------------------------------------------------ X9-X11, L2
NORM_OUT = ", ".join(f"norm_{c}" for c in O.NORM_COLS)


@register("area_normalized", O.build(f"SELECT product_area, segment, {NORM_OUT} FROM area_norm", "area_norm"))
def area_normalized(t):
    """Min-max normalised volume columns."""
    return sc.area_normalized(feat.area_features(t.feedback)).select(
        "product_area", "segment", *[f"norm_{c}" for c in O.NORM_COLS])


@register("area_scores", O.build(
    "SELECT product_area, segment, priority_score, risk_category FROM area_scored", "area_scored"))
def area_scores(t):
    """X10 + X11: weighted 0-100 priority and its bin (flagship)."""
    return sc.area_scores(feat.area_features(t.feedback)).select(
        "product_area", "segment", "priority_score", "risk_category")


@register("product_area_impact", O.build("SELECT * FROM product_area_impact", "product_area_impact"))
def product_area_impact(t):
    """L2: area scoring end to end, in the sink schema."""
    return sc.product_area_impact(t.feedback)


# ------------------------------------------------------------------ L1
@register("account_risk_scores", O.build(f"""
SELECT account_id, {O.r6('churn_probability')} AS churn_probability, {O.r6('health_score')} AS health_score,
  risk_category, predicted_at, model_version FROM account_risk_scores""", "account_risk_scores"))
def account_risk_scores(t):
    """L1: account scoring end to end (per-user grain, stored linear model)."""
    return round6(sc.account_risk_scores(t.feedback), "churn_probability", "health_score")


# ------------------------------------------------------------------ shared Spark inputs
def _area_scored(t):
    return sc.area_scores(feat.area_features(t.feedback))


def _account_scores(t):
    return sc.account_risk_scores(t.feedback)


def _labels(t):
    return ln.synthetic_labels(_user_features(t))


def _split(t):
    return ln.stratified_split(_labels(t))


def _user_features(t):
    """Per-user account features (A1 aggregate written once per query build)."""
    if "_user_features" not in t.__dict__:
        t.__dict__["_user_features"] = feat.account_features(t.feedback, grain="user")
    return t.__dict__["_user_features"]


def _linear_probs(t):
    return sc.score_accounts_linear(sc.standardize(feat.feature_matrix(_user_features(t))))


KEPT = ("account_id", "churned", "is_test")


def _scored_split(t):
    """Label, split and linear probability of every account, carried through one projection."""
    matrix = feat.feature_matrix(_split(t), keys=KEPT)
    return sc.score_accounts_linear(sc.standardize(matrix, keys=KEPT), keys=KEPT)


def _test_preds(t):
    return _scored_split(t).where("is_test").select("account_id", "churned", "churn_probability")


ACCT_SCORE_R6 = (f"account_id, {O.r6('churn_probability')} AS churn_probability, "
                 f"{O.r6('health_score')} AS health_score, risk_category")

# ------------------------------------------------------------------ P2, P3, P5
@register("acct_features_one", O.build(
    f"SELECT {ACCT_BASE_COLS}, {ACCT_DERIVED_COLS} FROM acct_features_one", "acct_features_one"))
def acct_features_one(t):
    """One account (tier grain), filtered after the aggregate."""
    return feat.account_features(t.feedback, grain="tier", account_id="enterprise").select(
        *_cols(ACCT_BASE_COLS), *_cols(ACCT_DERIVED_COLS))


O.cte("acct_base_one", "SELECT * FROM acct_base_tier WHERE account_id = 'enterprise'", "acct_base_tier")
O.cte("acct_features_one", O._account_features("acct_base_one"), "acct_base_one")


@register("area_features_one", O.build(
    f"SELECT {AREA_BASE_COLS}, {AREA_DERIVED_COLS} FROM area_features_one", "area_features_one"))
def area_features_one(t):
    """One product area, filtered before the group-by."""
    return feat.area_features(t.feedback, product_area="billing").select(
        *_cols(AREA_BASE_COLS), *_cols(AREA_DERIVED_COLS))


O.cte("area_base_one", O.CTES["area_base"][0].replace(
    "FROM fb_lookback", "FROM fb_lookback WHERE product_area = 'billing'"), "fb_lookback")
O.cte("area_features_one", O._area_features("area_base_one"), "area_base_one")


@register("acct_feature_matrix", O.build(
    "SELECT account_id, " + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in O.ACCOUNT_MATRIX_COLS)
    + " FROM acct_features_user", "acct_features_user"))
def acct_feature_matrix(t):
    """P5 + P6: ordered 20-column churn matrix (per user), NULLs as 0."""
    return feat.feature_matrix(feat.account_features(t.feedback, grain="user"))


@register("area_feature_matrix", O.build(
    "SELECT product_area, segment, " + ", ".join(
        f"COALESCE({c}, 0) AS {c}" for c in
        ("feedback_count feedback_last_30d feedback_last_7d negative_count positive_count critical_count p5_count "
         "avg_priority unique_topics regions_affected negative_ratio critical_ratio p5_ratio sentiment_score "
         "recent_activity_ratio segment_encoded enterprise_flag").split())
    + " FROM area_features", "area_features"))
def area_feature_matrix(t):
    """P5 + P6: ordered 17-column area matrix."""
    return feat.area_feature_matrix(feat.area_features(t.feedback))


# ------------------------------------------------------------------ X8, X11, X12, M1, M5
@register("risk_bucket_areas", O.build(
    "SELECT product_area, segment, priority_score, risk_category FROM area_scored", "area_scored"))
def risk_bucket_areas(t):
    """X11 with the lowest edge included (scoring variant)."""
    return _area_scored(t).select("product_area", "segment", "priority_score", "risk_category")


@register("risk_bucket_areas_strict", O.build(
    f"SELECT product_area, segment, priority_score, {O.area_bin_sql('priority_score', False)} AS risk_category "
    "FROM area_scored", "area_scored"))
def risk_bucket_areas_strict(t):
    """X11 without include_lowest (0 -> NULL)."""
    return sc.area_scores(feat.area_features(t.feedback), include_lowest=False).select(
        "product_area", "segment", "priority_score", "risk_category")


@register("risk_bucket_accounts", O.build(
    f"SELECT account_id, {O.r6('churn_probability')} AS churn_probability, risk_category FROM account_risk_scores",
    "account_risk_scores"))
def risk_bucket_accounts(t):
    """Left-closed probability buckets."""
    return round6(_account_scores(t).select("account_id", "churn_probability", "risk_category"), "churn_probability")


EFFECTIVE_OVERRIDES = {"negative_sentiment": 0.35, "recent_activity": 0.05, "not_a_weight": 9.0}
O.cte("area_scored_custom", f"""
SELECT *, {O._area_score_expr({k: v for k, v in EFFECTIVE_OVERRIDES.items()})} AS priority_score
FROM area_norm""", "area_norm")


@register("effective_weights", O.build(
    f"SELECT product_area, segment, priority_score, {O.area_bin_sql('priority_score')} AS risk_category "
    "FROM area_scored_custom", "area_scored_custom"))
def effective_weights(t):
    """S8 + X12: stored weight table, overrides only for known names, applied
    to the area scores (unknown override names are ignored)."""
    spark = t.spark
    overrides = spark.createDataFrame(list(EFFECTIVE_OVERRIDES.items()), "name string, weight double")
    w = sc.effective_weights(sc.default_weights(spark), overrides)
    return sc.area_scores(feat.area_features(t.feedback), weights=w).select(
        "product_area", "segment", "priority_score", "risk_category")


@register("scaled_features", O.build(
    "SELECT account_id, " + ", ".join(f"{O.r6(c)} AS {c}" for c in O.ACCOUNT_MATRIX_COLS) + " FROM acct_scaled_user",
    "acct_scaled_user"))
def scaled_features(t):
    """M1: population-std standardisation (zero variance divides by 1)."""
    return round6(sc.standardize(feat.feature_matrix(_user_features(t))), *O.ACCOUNT_MATRIX_COLS)


@register("score_accounts_linear", O.build(
    f"SELECT account_id, {O.r6('logit')} AS logit, {O.r6('churn_probability')} AS churn_probability "
    "FROM acct_linear_user", "acct_linear_user"))
def score_accounts_linear(t):
    """M5: stored linear churn model over standardised features."""
    return round6(_linear_probs(t), "logit", "churn_probability")


# ------------------------------------------------------------------ M2, M3, A10, A11, A18, M4
@register("synthetic_labels", O.build(
    f"SELECT account_id, {O.r6('churn_score')} AS churn_score, {O.r6('churn_prob')} AS churn_prob, "
    f"{O.r6('noise')} AS noise, churned FROM labels_user", "labels_user"))
def synthetic_labels(t):
    """M2: heuristic churn label with key-derived Gaussian noise."""
    return round6(_labels(t).select("account_id", "churn_score", "churn_prob", "noise", "churned"),
                  "churn_score", "churn_prob", "noise")


@register("class_balance", O.build("SELECT * FROM class_balance", "class_balance"))
def class_balance(t):
    """Class counts, minority size, implied test share."""
    return ln.class_balance(_labels(t))


@register("stratified_split", O.build("SELECT account_id, churned, is_test FROM split_user", "split_user"))
def stratified_split(t):
    """M3: key-hash split at the A11 test share."""
    return _split(t).select("account_id", "churned", "is_test")


@register("classification_metrics", O.build(f"""
SELECT c.n, c.tp, c.fp, c.fn, c.tn,
  {O.r6('CASE WHEN c.n > 0 THEN (c.tp + c.tn) / c.n END')} AS accuracy,
  {O.r6('CASE WHEN c.tp + c.fp > 0 THEN c.tp / (c.tp + c.fp) ELSE 0.0 END')} AS precision,
  {O.r6('CASE WHEN c.tp + c.fn > 0 THEN c.tp / (c.tp + c.fn) ELSE 0.0 END')} AS recall,
  {O.r6('CASE WHEN 2 * c.tp + c.fp + c.fn > 0 THEN (2 * c.tp) / (2 * c.tp + c.fp + c.fn) ELSE 0.0 END')} AS f1,
  {O.r6('a.auc')} AS auc
FROM (SELECT COUNT(*) AS n,
        COUNT(*) FILTER (WHERE churn_probability >= 0.5 AND churned = 1) AS tp,
        COUNT(*) FILTER (WHERE churn_probability >= 0.5 AND churned = 0) AS fp,
        COUNT(*) FILTER (WHERE churn_probability < 0.5 AND churned = 1) AS fn,
        COUNT(*) FILTER (WHERE churn_probability < 0.5 AND churned = 0) AS tn
      FROM test_preds) c CROSS JOIN auc a""", "test_preds", "auc"))
def classification_metrics(t):
    """A18 + W6: test-set metrics of the linear scorer against M2 labels."""
    return round6(ln.classification_metrics(_test_preds(t)), "accuracy", "precision", "recall", "f1", "auc")


@register("prediction_distribution", O.build(f"""
SELECT 'prediction_mean' AS metric_name, {O.r6('AVG(churn_probability)')} AS metric_value, COUNT(*) AS samples_count
FROM test_preds
UNION ALL
SELECT 'prediction_std', {O.r6('stddev_pop(churn_probability)')}, COUNT(*) FROM test_preds""", "test_preds"))
def prediction_distribution(t):
    """A10: mean and population std of test-set predictions."""
    return round6(ln.prediction_distribution(_test_preds(t)), "metric_value")


@register("churn_fit_predict", None)
def churn_fit_predict(t):
    """M4: fit logistic regression on the train split, predict every account
    (rows-only check; the optimiser is not the reference's)."""
    return _fit_predict(t).select("account_id", "churned", "is_test", "churn_probability")


def _fit_predict(t):
    matrix = feat.feature_matrix(_split(t), keys=KEPT)
    stats = sc.fit_scaler(matrix.where(~F.col("is_test")), O.ACCOUNT_MATRIX_COLS)  # training rows only
    data = sc.standardize(matrix, keys=KEPT, stats=stats)
    model = ln.fit_churn_classifier(data.where(~F.col("is_test")))
    return ln.predict_churn(model, data, keep=KEPT)


@register("fitted_metrics", None)
def fitted_metrics(t):
    """A18 + W6 of the fitted model (M4) on its test rows (rows-only: the fit is numerical)."""
    return ln.classification_metrics(_fit_predict(t).where("is_test"))


# ------------------------------------------------------------------ A5-A9, A13-A17, T1-T4, U1, P8, P9
@register("score_distribution", O.build(f"""
SELECT COUNT(*) AS n, MIN(priority_score) AS min_score,
  {O.r6('quantile_cont(priority_score, 0.25)')} AS q1_score,
  {O.r6('quantile_cont(priority_score, 0.5)')} AS median_score,
  {O.r6('quantile_cont(priority_score, 0.75)')} AS q3_score,
  MAX(priority_score) AS max_score, {O.r6('AVG(priority_score)')} AS mean_score,
  {O.r6('stddev_samp(priority_score)')} AS std_score
FROM area_scored""", "area_scored"))
def score_distribution(t):
    """A5: distribution of area priority scores."""
    return round6(rp.score_distribution(_area_scored(t)), "q1_score", "median_score", "q3_score", "mean_score",
                  "std_score")


def _cat_dist_sql(src: str) -> str:
    return f"""
SELECT risk_category, COUNT(*) AS count,
  COUNT(*) / (SELECT COUNT(*) FROM {src}) * CAST(100 AS DOUBLE) AS percent,
  CASE risk_category WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'high' THEN 2 WHEN 'critical' THEN 3 ELSE 4 END
    AS category_order
FROM {src} WHERE risk_category IS NOT NULL GROUP BY risk_category"""


@register("risk_distribution_areas", O.build(_cat_dist_sql("area_scored"), "area_scored"))
def risk_distribution_areas(t):
    """A6 over area bins."""
    return rp.category_distribution(_area_scored(t))


@register("risk_distribution_accounts", O.build(_cat_dist_sql("account_risk_scores"), "account_risk_scores"))
def risk_distribution_accounts(t):
    """A6 over account buckets."""
    return rp.category_distribution(_account_scores(t))


@register("priority_by_area", O.build(
    f"SELECT product_area, {O.r6('AVG(priority_score)')} AS avg_priority_score FROM product_area_impact "
    "GROUP BY product_area", "product_area_impact"))
def priority_by_area(t):
    """Mean priority per product area."""
    return round6(rp.mean_by(sc.product_area_impact(t.feedback), "product_area"), "avg_priority_score")


@register("priority_by_segment", O.build(
    f"SELECT segment, {O.r6('AVG(priority_score)')} AS avg_priority_score FROM product_area_impact "
    "GROUP BY segment", "product_area_impact"))
def priority_by_segment(t):
    """Mean priority per segment."""
    return round6(rp.mean_by(sc.product_area_impact(t.feedback), "segment"), "avg_priority_score")


@register("area_summary", O.build(f"""
SELECT COUNT(*) AS total_combinations, COUNT(DISTINCT product_area) AS product_areas,
  COUNT(DISTINCT segment) AS segments, {O.r6('AVG(priority_score)')} AS mean_priority_score,
  COUNT(*) FILTER (WHERE priority_score >= 50) AS high_priority
FROM product_area_impact""", "product_area_impact"))
def area_summary(t):
    """Area scoring summary."""
    return round6(rp.area_summary(sc.product_area_impact(t.feedback)), "mean_priority_score")


@register("account_summary", O.build(f"""
SELECT COUNT(*) AS total_accounts, {O.r6('AVG(churn_probability)')} AS mean_churn_probability,
  {O.r6('AVG(health_score)')} AS mean_health_score,
  COUNT(*) FILTER (WHERE churn_probability >= 0.5) AS high_or_critical,
  COUNT(*) FILTER (WHERE churn_probability < 0.5) AS low_or_medium
FROM account_risk_scores""", "account_risk_scores"))
def account_summary(t):
    """Account scoring summary."""
    return round6(rp.account_summary(_account_scores(t)), "mean_churn_probability", "mean_health_score")


@register("daily_feedback", O.build("""
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS feedback_date, COUNT(*) AS feedback_count
FROM feedback_enriched GROUP BY CAST(created_at AS DATE) ORDER BY CAST(created_at AS DATE) DESC LIMIT 7""",
    "feedback_enriched"))
def daily_feedback(t):
    """Feedback per day, newest 7 days."""
    return rp.daily_counts(t.feedback_core)


def _freshness_sql(src: str, name: str) -> str:
    return (f"SELECT '{name}' AS table_name, MAX(predicted_at) AS latest_prediction, COUNT(*) AS total_predictions, "
            f"COALESCE(epoch_us({O.AS_OF}) - epoch_us(MAX(predicted_at)) > 90000000000, TRUE) AS is_stale "
            f"FROM {src}")


@register("prediction_freshness", O.build(_freshness_sql("account_risk_scores", "account_risk_scores"),
                                          "account_risk_scores"))
def prediction_freshness(t):
    """Newest prediction time, count, stale flag (> 25 h)."""
    return rp.prediction_freshness(_account_scores(t), "account_risk_scores")


@register("predictions_freshness_all", O.build(
    _freshness_sql("account_risk_scores", "account_risk_scores") + "\nUNION ALL\n"
    + _freshness_sql("product_area_impact", "product_area_impact"), "account_risk_scores", "product_area_impact"))
def predictions_freshness_all(t):
    """Freshness of both prediction tables."""
    return rp.freshness_all(_account_scores(t), sc.product_area_impact(t.feedback))


@register("risk_category_counts", O.build(
    "SELECT risk_category, COUNT(*) AS count FROM account_risk_scores GROUP BY risk_category", "account_risk_scores"))
def risk_category_counts(t):
    """Accounts per risk category."""
    return rp.category_counts(_account_scores(t))


@register("feedback_profile", O.build("""
SELECT CASE GROUPING_ID(sentiment, product_area, priority) WHEN 3 THEN 'sentiment' WHEN 5 THEN 'product_area'
         ELSE 'priority' END AS dimension,
  CASE GROUPING_ID(sentiment, product_area, priority) WHEN 3 THEN sentiment WHEN 5 THEN product_area
         ELSE CAST(priority AS VARCHAR) END AS value,
  COUNT(*) AS count,
  COUNT(*) / (SELECT COUNT(*) FROM feedback_enriched) * CAST(100 AS DOUBLE) AS percent
FROM feedback_enriched GROUP BY GROUPING SETS ((sentiment), (product_area), (priority))""", "feedback_enriched"))
def feedback_profile(t):
    """Feedback profile by sentiment, area and priority."""
    return rp.feedback_profile(t.feedback_core)


@register("ml_insights", O.build("""
SELECT h.high_risk_accounts, tp.top_priority_area, tp.top_priority_score
FROM (SELECT COUNT(*) FILTER (WHERE risk_category IN ('high', 'critical')) AS high_risk_accounts
      FROM account_risk_scores) h
LEFT JOIN (SELECT product_area AS top_priority_area, priority_score AS top_priority_score
           FROM product_area_impact ORDER BY priority_score DESC, product_area, segment LIMIT 1) tp ON TRUE""",
    "account_risk_scores", "product_area_impact"))
def ml_insights(t):
    """High-risk count and top area in one record."""
    return rp.ml_insights(_account_scores(t), sc.product_area_impact(t.feedback))


@register("top_risk_accounts", O.build(
    f"SELECT {ACCT_SCORE_R6} FROM account_risk_scores ORDER BY churn_probability DESC, account_id LIMIT 10",
    "account_risk_scores"))
def top_risk_accounts(t):
    """Ten riskiest accounts."""
    return round6(rp.top_risk_accounts(_account_scores(t)).select(
        "account_id", "churn_probability", "health_score", "risk_category"), "churn_probability", "health_score")


@register("top_areas", O.build(
    "SELECT product_area, segment, priority_score, feedback_count, negative_count, critical_count "
    "FROM product_area_impact ORDER BY priority_score DESC, product_area, segment LIMIT 15", "product_area_impact"))
def top_areas(t):
    """Fifteen highest-priority areas."""
    return rp.top_areas(sc.product_area_impact(t.feedback)).select(
        "product_area", "segment", "priority_score", "feedback_count", "negative_count", "critical_count")


@register("top_priorities", O.build(
    "SELECT product_area, segment, priority_score, risk_category FROM area_scored WHERE priority_score >= 50 "
    "ORDER BY priority_score DESC, product_area, segment LIMIT 10", "area_scored"))
def top_priorities(t):
    """T3 + P7: top 10 areas at or above 50."""
    return rp.top_priorities(_area_scored(t)).select("product_area", "segment", "priority_score", "risk_category")


@register("latest_account_scores", O.build(
    f"SELECT {ACCT_SCORE_R6} FROM account_risk_scores ORDER BY predicted_at DESC, account_id LIMIT 10",
    "account_risk_scores"))
def latest_account_scores(t):
    """T4: newest ten account predictions."""
    s = _account_scores(t).orderBy(F.col("predicted_at").desc(), "account_id").limit(10)
    return round6(s.select("account_id", "churn_probability", "health_score", "risk_category"),
                  "churn_probability", "health_score")


@register("areas_above_threshold", O.build(
    "SELECT product_area, segment, priority_score FROM product_area_impact WHERE priority_score >= 50",
    "product_area_impact"))
def areas_above_threshold(t):
    """T4: all areas scoring at least 50, highest first."""
    return rp.top_n(sc.product_area_impact(t.feedback), None, "priority_score", ("product_area", "segment"),
                    min_value=50.0).select("product_area", "segment", "priority_score")


@register("high_risk_accounts", O.build(
    f"SELECT account_id, {O.r6('health_score')} AS health_score, risk_category FROM account_risk_scores "
    "WHERE risk_category IN ('high', 'critical')", "account_risk_scores"))
def high_risk_accounts(t):
    """Accounts in the high or critical bucket."""
    return round6(rp.high_risk_accounts(_account_scores(t)), "health_score")


ACCOUNT_LOOKUP = "42"


@register("account_health", O.build(
    f"SELECT {ACCT_SCORE_R6}, predicted_at, model_version FROM account_risk_scores "
    f"WHERE account_id = '{ACCOUNT_LOOKUP}'", "account_risk_scores"))
def account_health(t):
    """Point lookup of one account's prediction (the lookup is the feature)."""
    return round6(rp.account_health(_account_scores(t), ACCOUNT_LOOKUP), "churn_probability", "health_score")


# ------------------------------------------------------------------ W1-W4, J1, J3, L6, L7, L12, X15, X17, S7
@register("latest_version_metrics", O.build("SELECT * FROM latest_metrics", "latest_metrics"))
def latest_version_metrics(t):
    """Latest value per (version, dataset, metric)."""
    return reg.latest_version_metrics(t.model_metrics, dataset_type=None)


@register("latest_versions", O.build(
    "SELECT id, model_type, version, status, hyperparameters, created_at FROM ranked_versions WHERE rn = 1",
    "ranked_versions"))
def latest_versions(t):
    """Newest version per model type."""
    return reg.latest_versions(t.model_versions).select(
        "id", "model_type", "version", "status", "hyperparameters", "created_at")


@register("version_history", O.build(
    "SELECT id, model_type, version, created_at, CAST(rn AS INTEGER) AS rn FROM ranked_versions WHERE rn <= 10", "ranked_versions"))
def version_history(t):
    """Newest ten versions per model type."""
    return reg.version_history(t.model_versions).select("id", "model_type", "version", "created_at", "rn")


@register("previous_versions", O.build("""
SELECT model_type, COALESCE(MAX(CASE WHEN rn = 2 THEN id END), MAX(CASE WHEN rn = 1 THEN id END))
  AS previous_version_id
FROM ranked_versions WHERE rn <= 2 GROUP BY model_type""", "ranked_versions"))
def previous_versions(t):
    """Second newest version (or the only one)."""
    return reg.previous_versions(t.model_versions)


@register("active_versions", O.build("SELECT * FROM active_versions", "active_versions"))
def active_versions(t):
    """Deployed version rows."""
    return reg.active_versions(t.model_versions, t.model_deployments)


@register("next_versions", O.build("""
SELECT model_type, COALESCE(MAX(major), 0) AS max_major, 'v' || CAST(COALESCE(MAX(major), 0) + 1 AS VARCHAR)
  AS next_version
FROM (SELECT model_type,
        CASE WHEN regexp_extract(version, '^v?([0-9]+)(\\.|$)', 1) <> ''
             THEN CAST(regexp_extract(version, '^v?([0-9]+)(\\.|$)', 1) AS BIGINT) END AS major
      FROM model_versions) t
GROUP BY model_type""", "model_versions"))
def next_versions(t):
    """L6 + X15: next major version per model type."""
    return reg.next_versions(t.model_versions)


@register("hyperparameters_parsed", O.build("""
SELECT id, model_type, CAST(json_extract_string(hyperparameters, '$.lookback_days') AS INTEGER) AS lookback_days,
  CAST(json_extract_string(hyperparameters, '$.epochs') AS INTEGER) AS epochs,
  CAST(json_array_length(json_keys(hyperparameters)) AS INTEGER) AS n_params
FROM model_versions""", "model_versions"))
def hyperparameters_parsed(t):
    """JSON hyperparameters decoded."""
    return reg.hyperparameters_parsed(t.model_versions)


@register("version_improvements", O.build(
    f"SELECT model_type, previous_version_id, new_version_id, metric_name, prev_value, new_value, "
    f"{O.r6('improvement')} AS improvement FROM improvements", "improvements"))
def version_improvements(t):
    """J3 + X19: per-metric improvement of the newest over the active version."""
    pairs = reg.comparison_pairs(t.model_versions, t.model_deployments)
    return round6(reg.version_improvements(pairs, t.model_metrics), "improvement")


@register("promotion_decisions", O.build(
    f"SELECT model_type, previous_version_id, new_version_id, {O.r6('average_improvement')} AS average_improvement, "
    "n_metrics, promotion_recommended, promotion_reason, promotion_threshold FROM promotion", "promotion"))
def promotion_decisions(t):
    """L7 + A19: promote the newest version when it beats the active one."""
    return round6(reg.promotion_decisions(t.model_versions, t.model_deployments, t.model_metrics)
                  .drop("metric_improvements"), "average_improvement")


@register("model_comparisons", O.build(f"""
SELECT p.model_type, p.previous_version_id, p.new_version_id, {O.r6('p.average_improvement')} AS average_improvement,
  p.promotion_recommended, p.promotion_reason, {O.AS_OF} AS comparison_timestamp, i.metric_name,
  {O.r6('i.improvement')} AS improvement
FROM promotion p LEFT JOIN improvements i ON p.model_type = i.model_type
WHERE p.previous_version_id IS NOT NULL""", "promotion", "improvements"))
def model_comparisons(t):
    """L7's log rows; the JSON of improvements is unfolded to one row per metric."""
    rows = reg.model_comparisons(reg.promotion_decisions(t.model_versions, t.model_deployments, t.model_metrics))
    unfolded = rows.select("*", F.explode_outer(F.from_json("metric_improvements", "map<string,double>"))
                           .alias("metric_name", "improvement")).drop("metric_improvements")
    return round6(unfolded, "average_improvement", "improvement")


def _deploy(t):
    dec = reg.promotion_decisions(t.model_versions, t.model_deployments, t.model_metrics)
    patch = dec.where("promotion_recommended").select("model_type", F.col("new_version_id").alias("version_id"))
    return reg.deploy_versions(t.model_deployments, patch)


@register("deploy_versions", O.build("SELECT * FROM deployments_after", "deployments_after"))
def deploy_versions(t):
    """L12 + S7: deployments after promoting every recommended version."""
    return _deploy(t)


@register("version_status", O.build("""
SELECT v.id, v.model_type, v.version,
  CASE WHEN v.id IN (SELECT active_version_id FROM deployments_after WHERE deployed_at IS NOT NULL) THEN 'active'
       WHEN v.id IN (SELECT previous_version_id FROM deployments_after
                     WHERE deployed_at IS NOT NULL AND previous_version_id IS NOT NULL) THEN 'inactive'
       ELSE v.status END AS status,
  v.created_at, v.hyperparameters
FROM model_versions v""", "model_versions", "deployments_after"))
def version_status(t):
    """Version statuses after the deployment patch."""
    return reg.version_status_after_deploy(t.model_versions, _deploy(t))


# ------------------------------------------------------------------ L3, L8-L11
O.cte("retrain", f"""
SELECT model_type, last_training_date, latest_feedback_date, total_count, new_records,
  CASE WHEN no_data THEN NULL ELSE pct END AS percent_new_data,
  CASE WHEN first THEN NULL ELSE days END AS days_since_training,
  met AS rules_met, (NOT no_data AND met >= 2) AS decision_to_retrain,
  CASE WHEN no_data THEN 'No feedback data available'
       WHEN met >= 2 THEN concat_ws(' AND ',
         CASE WHEN c_days THEN days_txt || ' days since last training (min: 7)' END,
         CASE WHEN c_new THEN CAST(new_records AS VARCHAR) || ' new records (min: 100)' END,
         CASE WHEN c_pct THEN {O.fixed_1dp_sql('pct')} || '% new data (min: 5.0%)' END)
       ELSE 'Insufficient data freshness: ' || CAST(new_records AS VARCHAR) || ' new records ('
            || {O.fixed_1dp_sql('pct')} || '%), ' || days_txt || ' days since training' END AS reason,
  NOT no_data AS logged
FROM (SELECT *, CAST(c_days AS INTEGER) + CAST(c_new AS INTEGER) + CAST(c_pct AS INTEGER) AS met
      FROM (SELECT *, (first OR days >= 7) AS c_days, new_records >= 100 AS c_new, pct >= 5.0 AS c_pct,
                   CASE WHEN first THEN 'inf' ELSE CAST(days AS VARCHAR) END AS days_txt,
                   (latest_feedback_date IS NULL OR total_count = 0) AS no_data
            FROM (SELECT *, last_training_date IS NULL AS first,
                         CASE WHEN last_training_date IS NULL THEN CAST(100 AS DOUBLE)
                              WHEN total_count > 0 THEN new_records / total_count * CAST(100 AS DOUBLE)
                              ELSE CAST(0 AS DOUBLE) END AS pct,
                         {O.whole_days('last_training_date')} AS days
                  FROM (SELECT l.model_type, l.last_training_date, t.latest_feedback_date, t.total_count,
                          CASE WHEN l.last_training_date IS NULL THEN t.total_count
                               ELSE (SELECT COUNT(*) FROM feedback_enriched f
                                     WHERE f.created_at > l.last_training_date) END AS new_records
                        FROM (SELECT model_type, MAX(created_at) AS last_training_date
                              FROM model_versions GROUP BY model_type) l
                        CROSS JOIN (SELECT COUNT(*) AS total_count, MAX(created_at) AS latest_feedback_date
                                    FROM feedback_enriched) t) a) b) c) d""", "model_versions", "feedback_enriched")


@register("retrain_decisions", O.build("SELECT * FROM retrain", "retrain"))
def retrain_decisions(t):
    """L3: retrain decision and reason for every model type, one fact scan."""
    return mon.retrain_decisions(t.feedback_core, t.model_versions)


@register("prediction_drift", O.build(
    f"SELECT model_type, metric_name, n_values, {O.r6('recent')} AS recent, "
    f"{O.r6('average_older')} AS average_older, {O.r6('percent_change')} AS percent_change, drift_detected "
    "FROM drift", "drift"))
def prediction_drift(t):
    """Drift of the newest prediction statistic per model type and metric."""
    return round6(mon.prediction_drift(t.prediction_history, t.model_versions),
                  "recent", "average_older", "percent_change")


@register("drift_details", O.build(
    f"SELECT model_type, metric_name, {O.r6('recent')} AS recent, {O.r6('average_older')} AS average_older, "
    f"{O.r6('percent_change')} AS percent_change, {O.AS_OF} AS report_timestamp FROM drift WHERE drift_detected",
    "drift"))
def drift_details(t):
    """The drifted metrics behind the report."""
    return round6(mon.drift_details(t.prediction_history, t.model_versions), "recent", "average_older", "percent_change")


@register("model_staleness", O.build("SELECT * FROM staleness", "staleness"))
def model_staleness(t):
    """Active model age and stale flag per model type."""
    return mon.model_staleness(t.model_versions, t.model_deployments)


@register("metric_degradation", O.build("SELECT * FROM degradation", "degradation"))
def metric_degradation(t):
    """Active version accuracy below 0.80."""
    return mon.metric_degradation(t.model_versions, t.model_deployments, t.model_metrics)


def _health(t):
    return mon.health_report(t.model_versions, t.model_deployments, t.model_metrics, t.prediction_history)


@register("health_report", O.build("SELECT * FROM health", "health"))
def health_report(t):
    """Health report per model type."""
    return _health(t)


@register("health_alerts", O.build(f"""
SELECT model_type, concat_ws(' | ',
  CASE WHEN is_stale THEN 'STALENESS: ' || staleness_message END,
  CASE WHEN drift_detected THEN 'DRIFT: Prediction distribution has changed significantly' END,
  CASE WHEN is_degraded THEN 'DEGRADATION: ' || degradation_metric || ' is ' || {O.percent_2dp_sql('degradation_value')}
       || ' (threshold: ' || {O.percent_2dp_sql('degradation_threshold')} || ')' END) AS alert
FROM health WHERE overall_health = 'unhealthy'""", "health"))
def health_alerts(t):
    """Alert text for unhealthy model types."""
    return mon.health_alerts(_health(t))


# ------------------------------------------------------------------ S3, S4, S6, S10
PREVIOUS_AS_OF = "2024-01-01 00:00:00"
O.cte("scores_prev", O.CTES["account_risk_scores"][0]
      .replace(O.AS_OF, f"TIMESTAMP '{PREVIOUS_AS_OF}'").replace("'v1'", "'v0'")
      .replace("acct_linear_user", "acct_linear_prev"), "acct_linear_prev")
O.cte("fb_lookback_prev", O.CTES["fb_lookback"][0].replace(O.AS_OF, f"TIMESTAMP '{PREVIOUS_AS_OF}'"),
      "feedback_enriched")
O.cte("acct_base_prev", O._account_base("user", "fb_lookback_prev").replace(O.AS_OF, f"TIMESTAMP '{PREVIOUS_AS_OF}'"),
      "fb_lookback_prev")
O.cte("acct_features_prev", O._account_features("acct_base_prev").replace(O.AS_OF, f"TIMESTAMP '{PREVIOUS_AS_OF}'"),
      "acct_base_prev")
O.cte("acct_scaled_prev", O._standardize("acct_features_prev"), "acct_features_prev")
O.cte("acct_linear_prev", O.CTES["acct_linear_user"][0].replace("acct_scaled_user", "acct_scaled_prev"),
      "acct_scaled_prev")


@register("upsert_scores", O.build(f"""
SELECT COALESCE(n.account_id, o.account_id) AS account_id,
  {O.r6('CASE WHEN n.account_id IS NOT NULL THEN n.churn_probability ELSE o.churn_probability END')} AS churn_probability,
  {O.r6('CASE WHEN n.account_id IS NOT NULL THEN n.health_score ELSE o.health_score END')} AS health_score,
  CASE WHEN n.account_id IS NOT NULL THEN n.risk_category ELSE o.risk_category END AS risk_category,
  CASE WHEN n.account_id IS NOT NULL THEN n.predicted_at ELSE o.predicted_at END AS predicted_at,
  CASE WHEN n.account_id IS NOT NULL THEN n.model_version ELSE o.model_version END AS model_version
FROM scores_prev o FULL OUTER JOIN account_risk_scores n ON o.account_id = n.account_id""",
    "scores_prev", "account_risk_scores"))
def upsert_scores(t):
    """S3: today's account scores upserted over those of a month earlier."""
    old = sc.account_risk_scores(t.feedback, as_of=PREVIOUS_AS_OF, model_version="v0")
    new = _account_scores(t)
    cols = ["churn_probability", "health_score", "risk_category", "predicted_at", "model_version"]
    return round6(sk.upsert(old, new, ["account_id"], cols, unique_keys=True), "churn_probability", "health_score")


@register("insert_new_feedback", O.build(f"""
SELECT {FEEDBACK_COLS} FROM feedback_enriched b
WHERE b.created_at >= {O.days_before(60)}
  AND b.id NOT IN (SELECT id FROM feedback_enriched WHERE created_at < {O.days_before(30)})""",
    "feedback_enriched"))
def insert_new_feedback(t):
    """Feedback of the last 60 days inserted over the table as of 30 days
    ago; returns the rows actually inserted."""
    from voxlens.functions.time import days_before

    fb = t.feedback
    existing = t.feedback_core.where(F.col("created_at") < days_before(None, 30))  # ids only
    batch = fb.where(F.col("created_at") >= days_before(None, 60))
    return sk.insert_if_absent(existing, batch, "id", order_col="created_at")


@register("constraint_violations", O.build(f"""
SELECT 'product_area_impact' AS table_name, 'priority_score_range' AS rule, product_area || '|' || segment AS key
FROM product_area_impact WHERE NOT (priority_score >= 0 AND priority_score <= 100)
UNION ALL
SELECT 'account_risk_scores', 'risk_category_domain', account_id FROM account_risk_scores
WHERE risk_category IS NOT NULL AND risk_category NOT IN ('low', 'medium', 'high', 'critical')
UNION ALL
SELECT 'account_risk_scores', 'churn_probability_range', account_id FROM account_risk_scores
WHERE NOT (churn_probability >= 0 AND churn_probability <= 1)""", "product_area_impact", "account_risk_scores"))
def constraint_violations(t):
    """Rows breaking the prediction tables' NOT NULL / CHECK / key rules."""
    return sk.account_score_violations(sc.account_risk_scores(t.feedback)).unionByName(
        sk.area_impact_violations(sc.product_area_impact(t.feedback)))


@register("table_status", O.build("""
SELECT 'feedback_enriched' AS table_name, COUNT(*) AS row_count FROM feedback_enriched
UNION ALL SELECT 'account_risk_scores', COUNT(*) FROM account_risk_scores
UNION ALL SELECT 'product_area_impact', COUNT(*) FROM product_area_impact
UNION ALL SELECT 'model_versions', COUNT(*) FROM model_versions
UNION ALL SELECT 'model_metrics', COUNT(*) FROM model_metrics
UNION ALL SELECT 'model_deployments', COUNT(*) FROM model_deployments
UNION ALL SELECT 'prediction_distribution_history', COUNT(*) FROM prediction_distribution_history""",
    "feedback_enriched", "account_risk_scores", "product_area_impact", "model_versions", "model_metrics",
    "model_deployments", "prediction_distribution_history"))
def table_status(t):
    """Row counts of the pipeline tables."""
    return sk.table_status({
        "feedback_enriched": t.feedback_core,  # same rows, no customer join needed to count
        "account_risk_scores": _account_scores(t),
        "product_area_impact": sc.product_area_impact(t.feedback),
        "model_versions": t.model_versions,
        "model_metrics": t.model_metrics,
        "model_deployments": t.model_deployments,
        "prediction_distribution_history": t.prediction_history,
    })


# ------------------------------------------------------------------ L4/M6, S5, D1
@register("training_run", O.build("""
SELECT n_accounts, positives, n_accounts - positives AS negatives,
  CASE WHEN n_accounts < 5 THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN n_accounts < 5 THEN CAST(0 AS BIGINT) ELSE n_accounts - test_n END AS training_samples,
  CASE WHEN n_accounts < 5 THEN CAST(0 AS BIGINT) ELSE test_n END AS test_samples,
  CASE WHEN n_accounts = 0 THEN 'No data available for training. Ensure feedback_enriched table has data.'
       WHEN n_accounts < 5 THEN 'Insufficient data for training: ' || CAST(n_accounts AS VARCHAR)
                                || ' accounts (minimum 5 required)' END AS error_message
FROM (SELECT COUNT(*) AS n_accounts, CAST(COALESCE(SUM(churned), 0) AS BIGINT) AS positives,
             COUNT(*) FILTER (WHERE is_test) AS test_n FROM split_user) t""", "split_user"))
def training_run(t):
    """L4 + M6: training run record with the minimum-sample guard."""
    return ln.training_run_record(_split(t))


@register("data_freshness_log", O.build(f"""
SELECT model_type, {O.AS_OF} AS check_timestamp, last_training_date, latest_feedback_date,
  new_records AS new_feedback_count, percent_new_data, decision_to_retrain, reason
FROM retrain WHERE logged""", "retrain"))
def data_freshness_log(t):
    """Freshness-log rows appended by the retrain check (all columns filled)."""
    return mon.data_freshness_log(mon.retrain_decisions(t.feedback_core, t.model_versions))


O.cte("acct_scaled_tier", O._standardize("acct_features_tier", keys=("account_id", "region")), "acct_features_tier")
O.cte("acct_scores_tier", f"""
SELECT account_id, region, churn_probability, (1.0 - churn_probability) * 100 AS health_score,
  {O.churn_bucket_sql('churn_probability')} AS risk_category, {O.AS_OF} AS predicted_at, 'v1' AS model_version
FROM (SELECT account_id, region, 1.0 / (1.0 + exp(-logit)) AS churn_probability
      FROM (SELECT account_id, region, {O._logit_expr()} AS logit FROM acct_scaled_tier) a) b""",
      "acct_scaled_tier")


@register("account_risk_scores_tier", O.build(f"""
SELECT account_id, region, {O.r6('churn_probability')} AS churn_probability, {O.r6('health_score')} AS health_score,
  risk_category, predicted_at, model_version
FROM (SELECT *, row_number() OVER (PARTITION BY account_id
        ORDER BY churn_probability DESC, region IS NULL, region DESC) AS rn FROM acct_scores_tier) t
WHERE rn = 1""", "acct_scores_tier"))
def account_risk_scores_tier(t):
    """L1 at the reference grain (tier, region), collapsed to one row per
    account id deterministically (D1: highest probability, region desc, NULL last)."""
    s = sc.one_row_per_account(sc.account_risk_scores(t.feedback, grain="tier"))
    return round6(s.select("account_id", "region", "churn_probability", "health_score", "risk_category",
                           "predicted_at", "model_version"), "churn_probability", "health_score")


O.cte("split_exact_user", f"""
SELECT l.*, row_number() OVER (PARTITION BY l.churned
                               ORDER BY {O.keyed_uniform('l.account_id', 'split')}, l.account_id)
         <= CAST(floor(cb.test_size * COUNT(*) OVER (PARTITION BY l.churned) + 0.5) AS BIGINT) AS is_test
FROM labels_user l CROSS JOIN class_balance cb""", "labels_user", "class_balance")


@register("stratified_split_exact", O.build(
    "SELECT account_id, churned, is_test FROM split_exact_user", "split_exact_user"))
def stratified_split_exact(t):
    """M3 exact mode: per class, the round(test_size * n_c) smallest key hashes."""
    return ln.stratified_split_exact(_labels(t)).select("account_id", "churned", "is_test")


@register("priority_rollup", O.build(f"""
SELECT CASE GROUPING_ID(product_area, segment) WHEN 1 THEN 'product_area' ELSE 'segment' END AS dimension,
  CASE GROUPING_ID(product_area, segment) WHEN 1 THEN product_area ELSE segment END AS value,
  {O.r6('AVG(priority_score)')} AS avg_priority_score
FROM product_area_impact GROUP BY GROUPING SETS ((product_area), (segment))""", "product_area_impact"))
def priority_rollup(t):
    """Mean priority by area and by segment in one GROUPING SETS pass."""
    return round6(rp.mean_by_dimensions(sc.product_area_impact(t.feedback)), "avg_priority_score")


O.cte("next_versions", """
SELECT model_type, COALESCE(MAX(major), 0) AS max_major, 'v' || CAST(COALESCE(MAX(major), 0) + 1 AS VARCHAR)
  AS next_version
FROM (SELECT model_type,
        CASE WHEN regexp_extract(version, '^v?([0-9]+)(\\.|$)', 1) <> ''
             THEN CAST(regexp_extract(version, '^v?([0-9]+)(\\.|$)', 1) AS BIGINT) END AS major
      FROM model_versions) t
GROUP BY model_type""", "model_versions")


@register("training_plan", O.build(f"""
SELECT r.model_type, COALESCE(n.next_version, 'v1') AS version, 'training' AS status, {O.AS_OF} AS created_at,
  'models/' || r.model_type || '_model_' || COALESCE(n.next_version, 'v1') AS model_path,
  'models/' || r.model_type || '_model_' || COALESCE(n.next_version, 'v1') || '_scaler' AS scaler_path,
  r.reason AS description
FROM retrain r LEFT JOIN next_versions n ON r.model_type = n.model_type
WHERE r.decision_to_retrain""", "retrain", "next_versions"))
def training_plan(t):
    """L3 + L6 + S5/D7: version rows a scheduled retrain would create."""
    decisions = mon.retrain_decisions(t.feedback_core, t.model_versions)
    return mon.training_plan(decisions, reg.next_versions(t.model_versions))


@register("training_log_rows", O.build("""
SELECT 'churn' AS model_type, COALESCE((SELECT next_version FROM next_versions WHERE model_type = 'churn'), 'v1') AS version,
  'completed' AS status, n - test_n AS training_samples, test_n AS test_samples, m.metric_name
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_test) AS test_n FROM split_user) s
CROSS JOIN (SELECT unnest(['accuracy', 'precision', 'recall', 'f1', 'auc', 'prediction_mean', 'prediction_std'])
            AS metric_name) m
WHERE n >= 5
UNION ALL
SELECT 'churn', COALESCE((SELECT next_version FROM next_versions WHERE model_type = 'churn'), 'v1'), 'failed', 0, 0, NULL
FROM (SELECT COUNT(*) AS n FROM split_user) s WHERE n < 5""", "split_user", "next_versions"))
def training_log_rows(t):
    """The rows a training run logs, without the fitted figures."""
    return ln.training_log_rows(_split(t), reg.next_versions(t.model_versions))


O.cte("acct_scaled_stored", O._standardize("acct_features_user").replace(
    "FROM acct_features_user) x) s", "FROM acct_features_prev) x) s"), "acct_features_user", "acct_features_prev")
O.cte("acct_linear_stored", O.CTES["acct_linear_user"][0].replace("acct_scaled_user", "acct_scaled_stored"),
      "acct_scaled_stored")


@register("score_with_stored_scaler", O.build(
    f"SELECT account_id, {O.r6('logit')} AS logit, {O.r6('churn_probability')} AS churn_probability "
    "FROM acct_linear_stored", "acct_linear_stored"))
def score_with_stored_scaler(t):
    """M1 + M5 with a scaler fitted a month earlier and stored."""
    earlier = feat.feature_matrix(feat.account_features(t.feedback, PREVIOUS_AS_OF, grain="user"))
    scaler = sc.fit_scaler(earlier, O.ACCOUNT_MATRIX_COLS)
    scaled = sc.standardize(feat.feature_matrix(_user_features(t)), stats=scaler)
    return round6(sc.score_accounts_linear(scaled), "logit", "churn_probability")


# ------------------------------------------------------------------ L12, S7, L4 over time
PAST_DATES = ("2023-10-01 00:00:00", "2023-12-01 00:00:00", "2024-01-31 00:00:00")


@register("deployment_intervals", O.build("""
SELECT model_type, active_version_id, lag(active_version_id) OVER w AS previous_version_id, deployed_at AS valid_from,
  lead(deployed_at) OVER w AS valid_to, entry AS sequence, CAST(row_number() OVER w AS INTEGER) AS deployment_no,
  row_number() OVER (PARTITION BY model_type, active_version_id ORDER BY deployed_at, entry) > 1 AS is_rollback
FROM deployment_log WINDOW w AS (PARTITION BY model_type ORDER BY deployed_at, entry)""", "deployment_log"))
def deployment_intervals(t):
    """The deployment log as intervals in which each version was active."""
    return reg.deployment_intervals(t.deployment_log)


@register("active_versions_as_of", O.build(" UNION ALL ".join(
    f"SELECT TIMESTAMP '{at}' AS as_of, d.model_type, d.active_version_id, d.deployed_at, v.version, v.created_at "
    f"FROM ({O.deployed_as_of(at)}) d JOIN model_versions v ON v.id = d.active_version_id" for at in PAST_DATES),
    "deployment_log", "model_versions"))
def active_versions_as_of(t):
    """J1 + L12: the version of each model type that was active at three dates, rollbacks included."""
    from functools import reduce

    from voxlens.functions.time import as_of_lit

    held = reduce(lambda a, b: a.unionByName(b), [
        reg.deployments_as_of(t.deployment_log, at).select(as_of_lit(at).alias("as_of"), "*") for at in PAST_DATES])
    rows = t.model_versions.select(F.col("id").alias("active_version_id"), "version", "created_at")
    return held.join(rows, "active_version_id").select("as_of", "model_type", "active_version_id", "deployed_at",
                                                       "version", "created_at")


O.cte("staleness_past", O.CTES["staleness"][0].replace(O.AS_OF, f"TIMESTAMP '{PAST_DATES[1]}'").replace(
    "LEFT JOIN active_versions a ON", f"""LEFT JOIN (SELECT d.model_type, v.id, v.created_at FROM ({O.deployed_as_of(PAST_DATES[1])}) d
  JOIN model_versions v ON v.id = d.active_version_id) a ON"""), "type_domain", "deployment_log", "model_versions")


@register("model_staleness_as_of", O.build("SELECT * FROM staleness_past", "staleness_past"))
def model_staleness_as_of(t):
    """L9 asked for a past date: age of the versions that were active then."""
    held = reg.deployments_as_of(t.deployment_log, PAST_DATES[1])
    return mon.model_staleness(t.model_versions, held, PAST_DATES[1])


O.cte("runs_after", """
SELECT s.run_id, s.model_version_id, s.model_type, s.triggered_by, s.started_at, COALESCE(e.status, 'running') AS status,
  e.training_samples, e.test_samples, e.error_message, e.completed_at
FROM run_starts s LEFT JOIN run_ends e ON s.run_id = e.run_id""", "run_starts", "run_ends")


def _runs(t):
    started = t.run_starts.select(
        "*", F.lit("running").alias("status"), F.lit(None).cast("long").alias("training_samples"),
        F.lit(None).cast("long").alias("test_samples"), F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    return reg.complete_runs(started, t.run_ends)


@register("training_run_states", O.build("SELECT * FROM runs_after", "runs_after"))
def training_run_states(t):
    """Started runs closed by the rows of those that have ended."""
    return _runs(t)


@register("training_run_summary", O.build("""
SELECT model_type, COUNT(*) AS n_runs, COUNT(*) FILTER (WHERE status = 'running') AS n_running,
  COUNT(*) FILTER (WHERE status = 'completed') AS n_completed, COUNT(*) FILTER (WHERE status = 'failed') AS n_failed,
  CAST(SUM(training_samples) AS BIGINT) AS training_samples, MAX(completed_at) AS last_completed_at,
  MAX(CASE WHEN status = 'failed' AND rn = 1 THEN run_id END) AS last_failed_run,
  MAX(CASE WHEN status = 'failed' AND rn = 1 THEN error_message END) AS last_error
FROM (SELECT *, row_number() OVER (PARTITION BY model_type, status ORDER BY completed_at DESC, run_id DESC) AS rn
      FROM runs_after) r GROUP BY model_type""", "runs_after"))
def training_run_summary(t):
    """L4: runs of each model type by status, with the newest error."""
    return reg.run_summary(_runs(t))


# ------------------------------------------------------------------ S3, S4 at the cost of the patch
@register("upsert_scores_bucketed", O.build(str(REGISTRY["upsert_scores"][1])))
def upsert_scores_bucketed(t):
    """S3 on stored files: a month-old snapshot in hash buckets, today's scores upserted into the
    buckets that they touch, and the new snapshot read through its manifest."""
    import uuid

    from voxlens.session import stage_root

    base, cols = f"{stage_root(t.spark)}/scores-{uuid.uuid4().hex}", list(jobs.ACCOUNT_UPDATE_COLS)
    old = sc.account_risk_scores(t.feedback, as_of=PREVIOUS_AS_OF, model_version="v0")
    bk.write(old, base, "account_risk_scores", "old", ["account_id"])
    bk.upsert(_account_scores(t), base, "account_risk_scores", "old", "new", cols, unique_keys=True)
    return round6(bk.read(t.spark, base, "account_risk_scores", "new"), "churn_probability", "health_score")


@register("insert_new_feedback_indexed", O.build(str(REGISTRY["insert_new_feedback"][1])))
def insert_new_feedback_indexed(t):
    """S4 on stored files: the table as of 30 days ago with its id index, the feedback of the last 60
    days inserted through the index; returns the rows that the insert stored."""
    import uuid

    from voxlens.functions.time import days_before
    from voxlens.session import stage_root

    path = f"{stage_root(t.spark)}/feedback-{uuid.uuid4().hex}"
    idx.store(t.feedback.where(F.col("created_at") < days_before(None, 30)), path, 0)
    idx.insert(t.feedback.where(F.col("created_at") >= days_before(None, 60)), path, 1, "id", order_col="created_at")
    return t.spark.read.parquet(f"{path}/batch_id=1").select(*_cols(FEEDBACK_COLS))


# ------------------------------------------------------------------ P1, A1, A5, M4 at scale
def _stored_path(t, name: str) -> str:
    import uuid

    from voxlens.session import stage_root

    return f"{stage_root(t.spark)}/{name}-{uuid.uuid4().hex}"


@register("area_features_stored", O.build(str(REGISTRY["area_features"][1])))
def area_features_stored(t):
    """P1 + A2 over facts stored by date: the lookback prunes the partitions outside its window."""
    stored = t.spark.read.parquet(sk.write_feedback(t.feedback, _stored_path(t, "facts")))
    return feat.area_features(stored).select(*_cols(AREA_BASE_COLS), *_cols(AREA_DERIVED_COLS))


@register("acct_base_features_daily", O.build(str(REGISTRY["acct_base_features_user"][1])))
def acct_base_features_daily(t):
    """A1 per user from stored per-day partials; facts are read for the days that a window cuts."""
    facts = t.spark.read.parquet(sk.write_feedback(t.feedback, _stored_path(t, "facts")))
    stored = t.spark.read.parquet(daily.add_days(facts, _stored_path(t, "daily")))
    return daily.account_base_features(stored, facts).select("user_id", *_cols(ACCT_BASE_COLS))


@register("score_distribution_accounts", O.build(f"""
SELECT COUNT(*) AS n, {O.r6('MIN(churn_probability)')} AS min_score,
  {O.r6('quantile_cont(churn_probability, 0.25)')} AS q1_score, {O.r6('quantile_cont(churn_probability, 0.5)')} AS median_score,
  {O.r6('quantile_cont(churn_probability, 0.75)')} AS q3_score, {O.r6('MAX(churn_probability)')} AS max_score,
  {O.r6('AVG(churn_probability)')} AS mean_score, {O.r6('stddev_samp(churn_probability)')} AS std_score
FROM account_risk_scores""", "account_risk_scores"))
def score_distribution_accounts(t):
    """A5 at the account grain, by exact selection."""
    out = rp.score_distribution(_account_scores(t), "churn_probability", rows=100)
    return round6(out, *[c for c in out.columns if c != "n"])


@register("fit_quality", O.build("""
SELECT k.kind, COUNT(*) AS n_accounts, CASE WHEN k.kind = 'logistic' THEN CAST(0 AS DOUBLE) END AS max_abs_gradient,
  TRUE AS auc_above_half
FROM labels_user CROSS JOIN (SELECT unnest(['logistic', 'mlp']) AS kind) k GROUP BY k.kind""", "labels_user"))
def fit_quality(t):
    """M4 checked on all accounts: the gradient at the logistic solution (0 to 2 places), and whether each
    kind of classifier ranks the rows that it was fitted on better than chance."""
    from functools import reduce

    from voxlens.session import materialize

    matrix = feat.feature_matrix(_labels(t), keys=("account_id", "churned"))
    data, out = materialize(sc.standardize(matrix, keys=("account_id", "churned")), "fit_rows"), []
    for kind in ("logistic", "mlp"):
        model = ln.fit_churn_classifier(data, kind=kind)
        preds = ln.predict_churn(model, data, keep=("account_id", "churned"))
        auc = ln.roc_auc(preds).select((F.col("auc") > 0.5).alias("auc_above_half"))
        n = data.agg(F.count("*").alias("n_accounts"))
        gradient = t.spark.range(1).select(F.lit(None).cast("double").alias("max_abs_gradient"))
        if kind == "logistic":
            gradient = ln.optimality(model, data).select(F.round("max_abs_gradient", 2).alias("max_abs_gradient"))
        out.append(n.crossJoin(gradient).crossJoin(auc).select(F.lit(kind).alias("kind"), "*"))  # one row each
    return reduce(lambda a, b: a.unionByName(b), out)
