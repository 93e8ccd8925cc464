"""Account features from stored per-day partials (A1 without re-reading 90 days of facts).

A day's partial holds, per account key, sums that add up over days: counts, filtered
counts, the sum and number of priorities, the last time, the set of product areas (a
domain of a few names). A run adds the partials of new days; A1 at any ``as_of`` is then the sum
of the partials of the whole days inside each window and of the facts of the days that a
window's bound cuts (three at most: 90, 30 and 7 days back), read by their date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlens.config import ACCOUNT_AREA_COUNTS, LOOKBACK_DAYS, RECENT_7D, RECENT_30D
from voxlens.functions.time import days_before
from voxlens.operators.features import GRAINS

DAY = "created_date"


def _aggregates() -> list:
    sentiment = [F.count_if(F.col("sentiment") == name).alias(f"{name}_feedback") for name in ("negative", "positive", "neutral")]
    return [F.count(F.lit(1)).alias("total_feedback"), *sentiment,
            F.count_if(F.col("priority") >= 4).alias("critical_issues"), F.count_if(F.col("priority") == 5).alias("p5_issues"),
            F.sum("priority").alias("priority_sum"), F.count("priority").alias("priority_n"),
            F.max("created_at").alias("last_feedback_date"), F.collect_set("product_area").alias("areas"),
            *[F.count_if(F.col("product_area") == area).alias(name) for name, area in ACCOUNT_AREA_COUNTS.items()]]


SUMS = ("total_feedback", "negative_feedback", "positive_feedback", "neutral_feedback", "critical_issues", "p5_issues",
        "priority_sum", "priority_n", *ACCOUNT_AREA_COUNTS)


def partials(feedback: DataFrame, grain: str = "user") -> DataFrame:
    """One row per account key and day of ``feedback``."""
    facts = feedback if DAY in feedback.columns else feedback.withColumn(DAY, F.to_date("created_at"))
    return facts.groupBy(*GRAINS[grain], DAY).agg(*_aggregates())


def add_days(feedback: DataFrame, path: str, grain: str = "user", since: str | None = None) -> str:
    """Write the partials of the days of ``feedback`` (those after ``since``, a date, where given)
    by day. A day that is written again replaces its own folder only."""
    new = feedback if DAY in feedback.columns else feedback.withColumn(DAY, F.to_date("created_at"))
    if since is not None:
        new = new.where(F.col(DAY) > F.lit(since).cast("date"))
    partials(new, grain).hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(DAY).parquet(path)
    return path


def account_base_features(stored: DataFrame, feedback: DataFrame, as_of: str | None = None,
                          lookback_days: int = LOOKBACK_DAYS, grain: str = "user") -> DataFrame:
    """A1 from ``stored`` partials and the facts of the cut days; the rows and columns of
    ``features.account_base_features``. ``feedback`` needs ``created_date`` to be pruned by day."""
    keys = GRAINS[grain]
    cut = {n: days_before(as_of, n) for n in (lookback_days, RECENT_30D, RECENT_7D)}
    cut_days = [F.to_date(c) for c in cut.values()]
    windows = {"feedback_last_30d": RECENT_30D, "feedback_last_7d": RECENT_7D}
    day = F.col(DAY)

    whole = stored.where((day > F.to_date(cut[lookback_days])) & ~day.isin(*cut_days)).select(
        *keys, *SUMS, "last_feedback_date", "areas",
        *[F.when(day > F.to_date(cut[n]), F.col("total_feedback")).otherwise(F.lit(0)).alias(name) for name, n in windows.items()])
    facts = feedback if DAY in feedback.columns else feedback.withColumn(DAY, F.to_date("created_at"))
    parts = facts.where(day.isin(*cut_days) & (F.col("created_at") >= cut[lookback_days])).groupBy(*keys).agg(
        *_aggregates(), *[F.count_if(F.col("created_at") > cut[n]).alias(name) for name, n in windows.items()])
    both = whole.unionByName(parts.select(*whole.columns))
    out = both.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in (*SUMS, *windows)], F.max("last_feedback_date").alias("last_feedback_date"),
        F.size(F.array_distinct(F.flatten(F.collect_set("areas")))).cast("long").alias("product_areas_mentioned"))
    account_id = F.col("customer_tier") if grain == "tier" else F.col("user_id").cast("string")
    return out.select(account_id.alias("account_id"), *keys, "total_feedback", *windows, "negative_feedback", "positive_feedback",
                      "neutral_feedback", "critical_issues", "p5_issues",
                      (F.col("priority_sum") / F.col("priority_n")).alias("avg_priority"), "last_feedback_date",
                      "product_areas_mentioned", *ACCOUNT_AREA_COUNTS)
