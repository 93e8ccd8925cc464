"""Fixed values and defaults.

The lists and numbers in the FIXED VALUES block must equal the behaviour being
reproduced (domains, thresholds, weights, bin edges); they are stated here once
and imported everywhere else.
"""

from __future__ import annotations

# Reproducible "now" for every rule; never the wall clock.
DEFAULT_AS_OF = "2024-01-31 00:00:00"

# ---------------------------------------------------------------- FIXED VALUES
# Feature windows (days).
LOOKBACK_DAYS = 90
RECENT_30D = 30
RECENT_7D = 7

# Customer tier ordinal code; anything else (or NULL) is 0.
TIER_CODES = {"free": 0, "pro": 1, "enterprise": 2}

# Sentiment labels and the product areas counted in account features.
SENTIMENTS = ("positive", "neutral", "negative")
ACCOUNT_AREA_COUNTS = {
    "billing_issues": "billing",
    "performance_issues": "performance",
    "security_issues": "security",
}

# Ordered churn-model feature list (20 columns).
ACCOUNT_FEATURE_COLS = (
    "total_feedback",
    "feedback_last_30d",
    "feedback_last_7d",
    "negative_feedback",
    "positive_feedback",
    "critical_issues",
    "p5_issues",
    "avg_priority",
    "product_areas_mentioned",
    "billing_issues",
    "performance_issues",
    "security_issues",
    "negative_ratio",
    "positive_ratio",
    "critical_ratio",
    "days_since_last_feedback",
    "feedback_velocity",
    "billing_issue_flag",
    "region_encoded",
    "tier_encoded",
)

# Ordered area-model feature list (17 columns).
AREA_FEATURE_COLS = (
    "feedback_count",
    "feedback_last_30d",
    "feedback_last_7d",
    "negative_count",
    "positive_count",
    "critical_count",
    "p5_count",
    "avg_priority",
    "unique_topics",
    "regions_affected",
    "negative_ratio",
    "critical_ratio",
    "p5_ratio",
    "sentiment_score",
    "recent_activity_ratio",
    "segment_encoded",
    "enterprise_flag",
)

# Area priority weights: (weight name, normalised input column, default weight).
# The enterprise term uses the 0/1 flag without normalisation.
AREA_WEIGHTS = (
    ("feedback_volume", "feedback_count", 0.15),
    ("negative_sentiment", "negative_count", 0.25),
    ("critical_issues", "critical_count", 0.20),
    ("p5_issues", "p5_count", 0.15),
    ("recent_activity", "feedback_last_7d", 0.10),
    ("enterprise_impact", "enterprise_flag", 0.15),
)

# Right-closed area bins (0,30] (30,50] (50,70] (70,100].
AREA_BIN_EDGES = (0.0, 30.0, 50.0, 70.0, 100.0)
AREA_BIN_LABELS = ("low", "medium", "high", "critical")

# Left-closed churn probability buckets: <0.25 low, <0.5 medium, <0.75 high, else critical.
CHURN_BUCKET_EDGES = (0.25, 0.5, 0.75)
CHURN_BUCKET_LABELS = ("low", "medium", "high", "critical")
RISK_CATEGORIES = ("low", "medium", "high", "critical")

# Stored linear churn scorer on standardised features (all others weigh 0).
LINEAR_CHURN_BIAS = -0.2
LINEAR_CHURN_WEIGHTS = {
    "negative_ratio": 0.8,
    "critical_ratio": 0.6,
    "days_since_last_feedback": 0.4,
    "billing_issue_flag": 0.2,
    "positive_ratio": -0.5,
    "feedback_velocity": -0.3,
    "tier_encoded": -0.2,
}

# Synthetic churn label: weights, squash slope/centre, noise sd, threshold.
LABEL_WEIGHTS = {"negative_ratio": 0.4, "critical_ratio": 0.3, "billing_issue_flag": 0.2}
LABEL_DAYS_WEIGHT = 0.1
LABEL_DAYS_SCALE = 90.0
LABEL_SQUASH_SLOPE = 5.0
LABEL_SQUASH_CENTRE = 0.5
LABEL_NOISE_SD = 0.1
LABEL_THRESHOLD = 0.5

# Train/test split: default test share 1 - 0.2 = 0.8 (a parameter; the minority count is reported).
DEFAULT_TEST_SIZE = 0.8

# Retrain decision defaults.
MIN_NEW_DATA_PERCENT = 5.0
MIN_DAYS_SINCE_TRAINING = 7
MIN_NEW_RECORDS = 100
MIN_RULES_MET = 2

# Registry rules.
PROMOTION_THRESHOLD = 0.01
DRIFT_THRESHOLD = 0.15
DRIFT_WINDOW_ROWS = 20
MAX_DAYS_WITHOUT_TRAINING = 7
DEGRADATION_METRIC = "accuracy"
DEGRADATION_THRESHOLD = 0.80
VERSION_HISTORY_LIMIT = 10
STALE_PREDICTION_HOURS = 25

# Reports.
TOP_ACCOUNTS = 10
TOP_AREAS = 15
TOP_PRIORITIES = 10
PRIORITY_THRESHOLD = 50.0
CHURN_THRESHOLD = 0.5
DAILY_FEEDBACK_DAYS = 7
MIN_TRAINING_ACCOUNTS = 5
# ------------------------------------------------------------ END FIXED VALUES

DEFAULT_MODEL_VERSION = "v1"
