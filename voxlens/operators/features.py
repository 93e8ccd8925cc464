"""Feature tables: account features (A1) and product-area features (A2).

One ``groupBy().agg()`` per feature table: the filtered counts are
``count_if`` aggregates evaluated in the same pass, so each table costs one
fact scan and one shuffle of partially aggregated rows (map-side combine
means a hot account contributes one row per map task, not its raw rows). At
the per-user grain the aggregate reuses the fact join's partitioning on
``user_id`` (no second shuffle); a hot user there is split by AQE's skew
join (see ``session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.config import (
    ACCOUNT_AREA_COUNTS,
    ACCOUNT_FEATURE_COLS,
    AREA_FEATURE_COLS,
    LOOKBACK_DAYS,
    RECENT_7D,
    RECENT_30D,
)
from voxlens.functions.scalars import indicator, smoothed_ratio, tier_code
from voxlens.functions.time import as_of_lit, days_before, whole_days
from voxlens.session import materialize

GRAINS = {
    # account id = tier, one row per (tier, region): the reference's grain.
    "tier": ("customer_tier", "region"),
    # account id = user, the per-account grain that grows with the data.
    "user": ("user_id", "customer_tier", "region"),
}


def lookback(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """``created_at >= as_of - lookback`` (inclusive); pushed into the scan
    where ``created_at`` is stored (the test adapter computes it from ``ts``).

    When the facts are stored partitioned by ``created_date``
    (``sinks.write_feedback``), the implied ``created_date >= date(cutoff)``
    is added so the scan prunes whole partitions outside the window.
    """
    cutoff = days_before(as_of, lookback_days)
    if "created_date" in feedback.columns:
        feedback = feedback.filter(F.col("created_date") >= F.to_date(cutoff))
    return feedback.filter(F.col("created_at") >= cutoff)


def _common_aggs(as_of, prefix_total: str):
    c30 = F.col("created_at") > days_before(as_of, RECENT_30D)
    c7 = F.col("created_at") > days_before(as_of, RECENT_7D)
    return [
        F.count(F.lit(1)).alias(prefix_total),
        F.count_if(c30).alias("feedback_last_30d"),
        F.count_if(c7).alias("feedback_last_7d"),
    ]


def account_base_features(feedback: DataFrame, as_of: str | None = None,
                          lookback_days: int = LOOKBACK_DAYS, grain: str = "tier") -> DataFrame:
    """A1: 14 aggregates per account (P1 + A3 filtered counts)."""
    keys = GRAINS[grain]
    f = lookback(feedback, as_of, lookback_days)
    aggs = _common_aggs(as_of, "total_feedback") + [
        F.count_if(F.col("sentiment") == "negative").alias("negative_feedback"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_feedback"),
        F.count_if(F.col("sentiment") == "neutral").alias("neutral_feedback"),
        F.count_if(F.col("priority") >= 4).alias("critical_issues"),
        F.count_if(F.col("priority") == 5).alias("p5_issues"),
        F.avg("priority").alias("avg_priority"),
        F.max("created_at").alias("last_feedback_date"),
        F.count_distinct("product_area").alias("product_areas_mentioned"),
    ] + [F.count_if(F.col("product_area") == area).alias(name) for name, area in ACCOUNT_AREA_COUNTS.items()]
    out = f.groupBy(*keys).agg(*aggs)
    account_id = F.col("customer_tier") if grain == "tier" else F.col("user_id").cast("string")
    return out.select(account_id.alias("account_id"), *[c for c in out.columns])


def region_codes(df: DataFrame, column: str = "region") -> DataFrame:
    """code = rank of the sorted distinct non-NULL value (0-based).

    The window runs over the *distinct* values of a small categorical domain,
    never over facts; the result is joined back by key (AQE broadcasts it when
    its runtime size is below the broadcast threshold).
    """
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return distinct.select(column, (F.row_number().over(Window.orderBy(column)) - 1).alias(f"{column}_encoded"))


def account_features(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS,
                     grain: str = "tier", account_id: str | None = None, materialize_base: bool = True,
                     codes: DataFrame | None = None) -> DataFrame:
    """A1 + X1-X5 + W7. ``account_id`` (P2) filters after the aggregate, as a
    group-key predicate that Catalyst pushes below the group-by; region codes
    are then computed over the rows that remain (reference behaviour).

    The region-code domain is derived from the aggregated table itself, so
    the A1 aggregate has two consumers; it is written once
    (``materialize_base``) so the fact scan, join and aggregation run once,
    and every later pass (code table, scaler statistics) reads that file.

    ``codes`` (a ``region_codes`` table saved at fit time) fixes the region
    encoding (D12): scoring one account or a new batch then uses the training
    codes, unseen regions and NULL map to -1. Without it the codes are
    recomputed over the rows at hand, as the reference does.
    """
    base = account_base_features(feedback, as_of, lookback_days, grain)
    if account_id is not None:
        base = base.filter(F.col("account_id") == F.lit(account_id))
    if materialize_base:
        base = materialize(base, f"account_base_{grain}")
    derived = base.select(
        "*",
        smoothed_ratio("negative_feedback", "total_feedback").alias("negative_ratio"),
        smoothed_ratio("positive_feedback", "total_feedback").alias("positive_ratio"),
        smoothed_ratio("critical_issues", "total_feedback").alias("critical_ratio"),
        whole_days(F.col("last_feedback_date"), as_of_lit(as_of)).alias("days_since_last_feedback"),
        smoothed_ratio("feedback_last_7d", "feedback_last_30d").alias("feedback_velocity"),
        indicator(F.col("billing_issues") > 0).alias("billing_issue_flag"),
        tier_code("customer_tier").alias("tier_encoded"),
    )
    if codes is None:
        codes = region_codes(derived)
    return (derived.join(codes.select("region", "region_encoded"), "region", "left")
            .withColumn("region_encoded", F.coalesce("region_encoded", F.lit(-1))))


def area_base_features(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS,
                       product_area: str | None = None, topic_parts: int = 1) -> DataFrame:
    """A2: 12 aggregates per (product_area, segment) in one aggregate over one shuffle.

    The two distinct counts are the sizes of sets that ride in it, so no fact row is
    expanded; a map task ships a group's distinct topics and regions once. For a consumer
    that selects neither, Catalyst prunes both sets. Where a group may have more topics than a
    task should hold, ``topic_parts`` deals them by hash into as many partial groups, whose sums
    and disjoint sets a second, small aggregate adds up.
    """
    f = lookback(feedback, as_of, lookback_days)
    if product_area is not None:  # P3: before the group-by
        f = f.filter(F.col("product_area") == F.lit(product_area))
    counts = ["feedback_count", "feedback_last_30d", "feedback_last_7d", "negative_count", "positive_count",
              "neutral_count", "critical_count", "p5_count"]
    aggs = _common_aggs(as_of, "feedback_count") + [
        F.count_if(F.col("sentiment") == "negative").alias("negative_count"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment") == "neutral").alias("neutral_count"),
        F.count_if(F.col("priority") >= 4).alias("critical_count"),
        F.count_if(F.col("priority") == 5).alias("p5_count")]
    f = f.withColumn("segment", F.col("customer_tier"))
    if topic_parts == 1:
        return f.groupBy("product_area", "segment").agg(
            *aggs, F.avg("priority").alias("avg_priority"), F.max("created_at").alias("last_feedback_date"),
            F.size(F.collect_set("topic")).cast("long").alias("unique_topics"),
            F.size(F.collect_set("region")).cast("long").alias("regions_affected"))
    part = F.coalesce(F.pmod(F.xxhash64("topic"), F.lit(topic_parts)), F.lit(0)).alias("_part")
    parts = f.groupBy("product_area", "segment", part).agg(
        *aggs, F.sum("priority").alias("_sum"), F.count("priority").alias("_n"),
        F.max("created_at").alias("last_feedback_date"), F.size(F.collect_set("topic")).cast("long").alias("_topics"),
        F.collect_set("region").alias("_regions"))
    return parts.groupBy("product_area", "segment").agg(
        *[F.sum(c).alias(c) for c in counts], (F.sum("_sum") / F.sum("_n")).alias("avg_priority"),
        F.max("last_feedback_date").alias("last_feedback_date"), F.sum("_topics").alias("unique_topics"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_regions")))).cast("long").alias("regions_affected"))


def area_features(feedback: DataFrame, as_of: str | None = None, lookback_days: int = LOOKBACK_DAYS,
                  product_area: str | None = None) -> DataFrame:
    """A2 + X1, X2, X4, X5."""
    base = area_base_features(feedback, as_of, lookback_days, product_area)
    sentiment = ((F.col("positive_count") - F.col("negative_count")).cast("double")
                 / (F.col("feedback_count") + F.lit(1)))
    return base.select(
        "*",
        smoothed_ratio("negative_count", "feedback_count").alias("negative_ratio"),
        smoothed_ratio("critical_count", "feedback_count").alias("critical_ratio"),
        smoothed_ratio("p5_count", "feedback_count").alias("p5_ratio"),
        sentiment.alias("sentiment_score"),
        sentiment.alias("avg_sentiment_score"),
        smoothed_ratio("feedback_last_7d", "feedback_last_30d").alias("recent_activity_ratio"),
        tier_code("segment").alias("segment_encoded"),
        indicator(F.col("segment") == "enterprise").alias("enterprise_flag"),
    )


def feature_matrix(df: DataFrame, feature_cols=ACCOUNT_FEATURE_COLS, keys=("account_id",)) -> DataFrame:
    """P5 + P6: the ordered feature columns that exist, NULLs filled with 0.

    Missing columns are skipped (schema-only check, no job). Counts keep their
    integer type; derived ratios stay double.
    """
    present = [c for c in feature_cols if c in df.columns]
    return df.select(*[k for k in keys if k in df.columns], *present).na.fill(0, subset=present)


def area_feature_matrix(df: DataFrame) -> DataFrame:
    return feature_matrix(df, AREA_FEATURE_COLS, keys=("product_area", "segment"))
