"""Scoring: area priority (X9-X11), account churn (M1, M5, X7, X8) and the two
end-to-end scoring jobs (L1, L2).

Account scaling statistics (mean/std) are one-row aggregates computed with
partial aggregation and joined back with ``broadcast`` -- the broadcast side
is provably a single row whatever the data size. Area min/max runs as a window
over the aggregated area table, whose size is bounded by its category domains.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxlens.config import (
    ACCOUNT_FEATURE_COLS,
    AREA_WEIGHTS,
    DEFAULT_MODEL_VERSION,
    LINEAR_CHURN_BIAS,
    LINEAR_CHURN_WEIGHTS,
    LOOKBACK_DAYS,
)
from voxlens.functions.scalars import area_bin, churn_bucket, logistic, min_max
from voxlens.functions.time import as_of_lit
from voxlens.operators.features import account_features, area_features, feature_matrix

NORMALISED = [c for _, c, _ in AREA_WEIGHTS if c != "enterprise_flag"]
WEIGHT_NAMES = [name for name, _, _ in AREA_WEIGHTS]


def default_weights(spark: SparkSession) -> DataFrame:
    """The default rule weights as a small ``(name, weight)`` table."""
    return spark.createDataFrame([(n, float(w)) for n, _, w in AREA_WEIGHTS], "name string, weight double")


def effective_weights(defaults: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """Only known names change; unknown override names are ignored."""
    if overrides is None:
        return defaults
    o = overrides.select("name", F.col("weight").alias("override"))
    return (defaults.join(o, "name", "left")
            .select("name", F.coalesce("override", "weight").alias("weight")))


def _weight_row(weights: DataFrame | None) -> DataFrame | None:
    if weights is None:
        return None
    return weights.agg(*[F.max(F.when(F.col("name") == n, F.col("weight"))).alias(f"w_{n}") for n in WEIGHT_NAMES])


def area_normalized(features: DataFrame) -> DataFrame:
    """Min-max of the five volume columns over all rows; constant -> 0.5.

    ``features`` is the aggregated (product_area, segment) table, whose size is
    bounded by the two category domains (tens of rows) however large the fact
    table is; an unpartitioned window over it costs one tiny exchange and,
    unlike a separate min/max aggregate joined back, does not evaluate the
    fact-table aggregation twice.
    """
    everything = Window.partitionBy()
    return features.select(
        *features.columns,
        *[min_max(c, F.min(c).over(everything), F.max(c).over(everything)).alias(f"norm_{c}")
          for c in NORMALISED],
    )


def area_scores(features: DataFrame, weights: DataFrame | None = None, include_lowest: bool = True) -> DataFrame:
    """X10 + X11: ``sum(norm * w * 100)`` in the reference's term order, then bins."""
    normed = area_normalized(features)
    wrow = _weight_row(weights)
    if wrow is not None:
        normed = normed.crossJoin(F.broadcast(wrow))  # one-row side
    terms = []
    for name, column, default in AREA_WEIGHTS:
        w = F.col(f"w_{name}") if wrow is not None else F.lit(default)
        x = F.col(column) if column == "enterprise_flag" else F.col(f"norm_{column}")
        terms.append(x * w * F.lit(100))
    score = reduce(lambda a, b: a + b, terms)
    out = normed.select(*features.columns, score.alias("priority_score"))
    return out.withColumn("risk_category", area_bin("priority_score", include_lowest))


def standardize(matrix: DataFrame, feature_cols=ACCOUNT_FEATURE_COLS, keys=("account_id",),
                stats: DataFrame | None = None) -> DataFrame:
    """M1: ``(x - mean) / population std``; zero variance divides by 1.

    ``stats`` (a one-row frame of ``mean_c``/``std_c``) is the fitted scaler;
    when absent it is fitted on ``matrix`` itself -- a second pass over
    ``matrix``, so callers pass a plan over a materialised table (see
    ``account_features``), never one that re-aggregates facts.
    """
    cols = [c for c in feature_cols if c in matrix.columns]
    if stats is None:
        stats = fit_scaler(matrix, cols)
    joined = matrix.crossJoin(F.broadcast(stats))  # one-row side
    scaled = []
    for c in cols:
        std = F.col(f"std_{c}")
        scale = F.when(std.isNull() | (std < F.lit(1e-12)), F.lit(1.0)).otherwise(std)
        scaled.append(((F.col(c) - F.col(f"mean_{c}")) / scale).alias(c))
    return joined.select(*[k for k in keys if k in matrix.columns], *scaled)


def fit_scaler(matrix: DataFrame, cols) -> DataFrame:
    return matrix.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols],
                      *[F.stddev_pop(c).alias(f"std_{c}") for c in cols])


def linear_churn_logit(scaled: DataFrame, bias: float = LINEAR_CHURN_BIAS,
                       weights: dict = LINEAR_CHURN_WEIGHTS):
    terms = [F.lit(float(w)) * F.col(c) for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(bias)))


def score_accounts_linear(scaled: DataFrame, bias: float = LINEAR_CHURN_BIAS,
                          weights: dict = LINEAR_CHURN_WEIGHTS, keys=("account_id",)) -> DataFrame:
    """M5: stored linear model, ``p = 1 / (1 + exp(-(b + sum w z)))``."""
    logit = linear_churn_logit(scaled, bias, weights)
    return scaled.select(*keys, logit.alias("logit"), logistic(logit).alias("churn_probability"))


def with_health_and_bucket(probs: DataFrame) -> DataFrame:
    """X7 + X8."""
    return probs.withColumns({
        "health_score": (F.lit(1.0) - F.col("churn_probability")) * F.lit(100),
        "risk_category": churn_bucket("churn_probability"),
    })


def account_risk_scores(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS,
                        grain: str = "user", model_version: str = DEFAULT_MODEL_VERSION,
                        scaler: DataFrame | None = None, codes: DataFrame | None = None, model=None,
                        account_id: str | None = None) -> DataFrame:
    """L1: A1 -> X1-X5 -> P5 -> M1 -> M5 -> X7, X8, in the sink's schema.

    ``scaler``, ``codes`` and ``model`` are the artifacts of a training run; where
    they are absent the scaler and codes come from the rows at hand and the
    stored linear scorer is used. With them, one account (``account_id``) gets
    the score that it has in a full run.

    The default grain is per user, so ``account_id`` is unique (the
    reference's tier grain is available as ``grain="tier"``; see
    ``one_row_per_account`` for its deterministic collapse).
    """
    keys = ("account_id", "region") if grain == "tier" else ("account_id",)
    # account_features writes the A1 aggregate once; both scaler passes read it.
    feats = account_features(feedback, as_of, lookback_days, grain, account_id=account_id, codes=codes)
    scaled = standardize(feature_matrix(feats, keys=keys), keys=keys, stats=scaler)
    if model is None:
        probs = score_accounts_linear(scaled, keys=keys)
    else:
        from voxlens.operators.learn import predict_churn

        probs = predict_churn(model, scaled, keep=keys)
    probs = with_health_and_bucket(probs)
    return probs.select(
        "account_id",
        *(["region"] if grain == "tier" else []),
        "churn_probability",
        "health_score",
        "risk_category",
        as_of_lit(as_of).alias("predicted_at"),
        F.lit(model_version).alias("model_version"),
    )


def one_row_per_account(scores: DataFrame) -> DataFrame:
    """Keep the highest churn probability per account id, ties by region
    descending with NULL last -- a deterministic, partially aggregated max."""
    region_key = F.struct(F.col("region").isNotNull().alias("has_region"), F.col("region"))
    best = F.max(F.struct(F.col("churn_probability"), region_key.alias("rk"),
                          F.struct(*[c for c in scores.columns if c not in ("account_id",)]).alias("row")))
    return scores.groupBy("account_id").agg(best.alias("b")).select("account_id", "b.row.*")


def product_area_impact(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS,
                        model_version: str = DEFAULT_MODEL_VERSION, weights: DataFrame | None = None) -> DataFrame:
    """L2: A2 -> X1-X5 -> X9-X11, in the sink's schema."""
    scored = area_scores(area_features(feedback, as_of, lookback_days), weights)
    return scored.select(
        "product_area", "segment", "priority_score", "feedback_count", "avg_sentiment_score",
        "negative_count", "critical_count",
        as_of_lit(as_of).alias("predicted_at"), F.lit(model_version).alias("model_version"),
    )
