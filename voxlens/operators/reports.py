"""Read-side reports over the feature, score and prediction tables.

Top-k reads use ``orderBy(...).limit(k)`` (planned as TakeOrderedAndProject:
each task keeps k rows, one final merge); the limit is the feature. Every
ordering carries the key columns last so ties are resolved deterministically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.config import (
    CHURN_THRESHOLD,
    DAILY_FEEDBACK_DAYS,
    PRIORITY_THRESHOLD,
    STALE_PREDICTION_HOURS,
    TOP_ACCOUNTS,
    TOP_AREAS,
    TOP_PRIORITIES,
)
from voxlens.functions.scalars import category_rank
from voxlens.session import materialize
from voxlens.functions.time import MICROS_PER_HOUR, as_of_lit, micros_between


#: Rows that are put in order at once to find a quantile; relative accuracy of the sketches before.
QUANTILE_ROWS = 10_000
SKETCH = 10_000


def order_statistics(df: DataFrame, column: str, ranks: list[int], n: int, rows: int = QUANTILE_ROWS,
                     accuracy: int = SKETCH) -> dict[int, float]:
    """The values at 0-based ``ranks`` of the ``n`` non-NULL values of ``column``, exactly.

    A sketch gives a range around each rank and one aggregate counts what lies below and
    in it; the range shrinks by the sketch's accuracy in each round, until it is one value or
    has ``rows`` values, which alone are put in order. No task holds more than that.
    """
    x = F.col(column)
    found: dict[int, float] = {}
    spans = {r: (None, None, 0, n) for r in sorted(set(ranks))}  # least, largest, values below, values in it

    def inside(span):
        return F.lit(True) if span[0] is None else (x >= F.lit(span[0])) & (x <= F.lit(span[1]))

    while spans:
        few = {r: s for r, s in spans.items() if s[3] <= rows}
        if few:
            row = df.agg(*[F.array_sort(F.collect_list(F.when(inside(s), x))).alias(f"v{r}") for r, s in few.items()]).first()
            found |= {r: row[f"v{r}"][r - s[2]] for r, s in few.items()}
        spans = {r: s for r, s in spans.items() if r not in few}
        if not spans:
            break
        asked = []
        for r, s in spans.items():
            at, slack = (r - s[2] + 0.5) / s[3], 2 / accuracy
            ends = [F.lit(max(0.0, at - slack)), F.lit(min(1.0, at + slack))]
            asked.append(F.percentile_approx(F.when(inside(s), x), F.array(*ends), accuracy).alias(f"e{r}"))
        edges = df.agg(*asked).first()
        lo, hi = ({r: edges[f"e{r}"][k] for r in spans} for k in (0, 1))
        counts = df.agg(*[c for r in spans for c in (
            F.count_if(x < F.lit(lo[r])).alias(f"b{r}"), F.count_if((x >= F.lit(lo[r])) & (x <= F.lit(hi[r]))).alias(f"n{r}"))]).first()
        for r in list(spans):
            below, own, last = counts[f"b{r}"], counts[f"n{r}"], spans[r]
            if below <= r < below + own and lo[r] == hi[r]:
                found[r] = lo[r]
                del spans[r]
            elif below <= r < below + own and own < last[3]:
                spans[r] = (lo[r], hi[r], below, own)
            elif r < below:  # the sketch was off: the rank lies on the other side of an edge
                spans[r] = (last[0] if last[0] is not None else df.agg(F.min(x)).first()[0], lo[r], last[2], below - last[2] + own)
            elif r >= below + own:
                rest = last[3] - (below - last[2])
                spans[r] = (lo[r], last[1] if last[1] is not None else df.agg(F.max(x)).first()[0], below, rest)
            else:
                accuracy *= 10  # no progress: a finer sketch
    return found


def score_distribution(scored: DataFrame, column: str = "priority_score", rows: int = QUANTILE_ROWS) -> DataFrame:
    """A5: min, Q1, median, Q3, max, mean, sample std (one row), at any number of rows.

    Quantiles interpolate linearly between order statistics, like pandas ``quantile`` and
    DuckDB ``quantile_cont``; these are selected exactly without a task that holds all values
    (``order_statistics``). ``n`` counts all rows, the quantiles are of the non-NULL values.
    """
    one = materialize(scored.select(F.col(column).cast("double").alias("x")), "score_values")
    whole = one.agg(F.count(F.lit(1)).alias("n"), F.count("x").alias("m"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                    F.avg("x").alias("mean"), F.stddev_samp("x").alias("std")).first()
    places = {q: (whole.m - 1) * q for q in (0.25, 0.5, 0.75)} if whole.m else {}
    values = order_statistics(one, "x", [r for h in places.values() for r in (int(h), min(int(h) + 1, whole.m - 1))], whole.m, rows)
    q = {k: values[int(h)] + (h - int(h)) * (values[min(int(h) + 1, whole.m - 1)] - values[int(h)]) for k, h in places.items()}
    row = (whole.n, whole.lo, q.get(0.25), q.get(0.5), q.get(0.75), whole.hi, whole["mean"], whole["std"])
    return scored.sparkSession.createDataFrame([row], "n long, min_score double, q1_score double, median_score double, "
                                               "q3_score double, max_score double, mean_score double, std_score double")


def category_distribution(scored: DataFrame, column: str = "risk_category") -> DataFrame:
    """Count per category and percent of *all* rows (NULL category rows
    are excluded from the counts but included in the total).

    One pass: the total is the sum of the per-category counts (NULL group
    included), taken by a window over the grouped rows -- at most one row per
    category plus NULL, whatever the input size.
    """
    counts = scored.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return (counts.select(column, "count", total.alias("total"))
            .where(F.col(column).isNotNull())
            .select(column, "count",
                    (F.col("count") / F.col("total") * F.lit(100.0)).alias("percent"),
                    category_rank(column).alias("category_order")))


def mean_by(scored: DataFrame, key: str, value: str = "priority_score") -> DataFrame:
    """Mean of ``value`` per ``key``, highest first."""
    return (scored.groupBy(key).agg(F.avg(value).alias(f"avg_{value}"))
            .orderBy(F.col(f"avg_{value}").desc(), key))


def mean_by_dimensions(scored: DataFrame, keys=("product_area", "segment"), value: str = "priority_score") -> DataFrame:
    """A7, both reports in one pass: ``GROUPING SETS ((k1), (k2), ...)`` ->
    ``(dimension, value, avg_<value>)``."""
    keys = list(keys)
    grouped = scored.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("gid"), F.avg(value).alias(f"avg_{value}"))
    n = len(keys)
    dim = val = None
    for i, k in enumerate(keys):
        gid = (1 << n) - 1 - (1 << (n - 1 - i))  # every key aggregated except k
        cond = F.col("gid") == gid
        dim = F.when(cond, F.lit(k)) if dim is None else dim.when(cond, F.lit(k))
        val = F.when(cond, F.col(k).cast("string")) if val is None else val.when(cond, F.col(k).cast("string"))
    return grouped.select(dim.alias("dimension"), val.alias("value"), f"avg_{value}")


def area_summary(scored: DataFrame) -> DataFrame:
    """Totals of the area scoring run (one row)."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_combinations"),
        F.count_distinct("product_area").alias("product_areas"),
        F.count_distinct("segment").alias("segments"),
        F.avg("priority_score").alias("mean_priority_score"),
        F.count_if(F.col("priority_score") >= PRIORITY_THRESHOLD).alias("high_priority"),
    )


def account_summary(scores: DataFrame) -> DataFrame:
    """Totals of the account scoring run (one row)."""
    return scores.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.avg("churn_probability").alias("mean_churn_probability"),
        F.avg("health_score").alias("mean_health_score"),
        F.count_if(F.col("churn_probability") >= CHURN_THRESHOLD).alias("high_or_critical"),
        F.count_if(F.col("churn_probability") < CHURN_THRESHOLD).alias("low_or_medium"),
    )


def daily_counts(feedback: DataFrame, days: int = DAILY_FEEDBACK_DAYS) -> DataFrame:
    """A13 + X14: feedback per calendar day, newest ``days`` days (date as text)."""
    return (feedback.groupBy(F.to_date("created_at").alias("d")).agg(F.count(F.lit(1)).alias("feedback_count"))
            .orderBy(F.col("d").desc()).limit(days)
            .select(F.col("d").cast("string").alias("feedback_date"), "feedback_count"))


def prediction_freshness(predictions: DataFrame, table_name: str, as_of: str | None = None,
                         stale_hours: int = STALE_PREDICTION_HOURS) -> DataFrame:
    """Newest ``predicted_at``, row count, stale if older than 25 h."""
    agg = predictions.agg(F.max("predicted_at").alias("latest_prediction"),
                          F.count(F.lit(1)).alias("total_predictions"))
    age = micros_between(F.col("latest_prediction"), as_of_lit(as_of))
    return agg.select(F.lit(table_name).alias("table_name"), "latest_prediction", "total_predictions",
                      F.coalesce(age > F.lit(stale_hours * MICROS_PER_HOUR), F.lit(True)).alias("is_stale"))


def freshness_all(account_scores: DataFrame, area_impact: DataFrame, as_of: str | None = None) -> DataFrame:
    """Freshness of both prediction tables, ``UNION ALL``."""
    return prediction_freshness(account_scores, "account_risk_scores", as_of).unionByName(
        prediction_freshness(area_impact, "product_area_impact", as_of))


def category_counts(scores: DataFrame, column: str = "risk_category") -> DataFrame:
    """Rows per category (NULL is its own group, as in SQL)."""
    return scores.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def feedback_profile(batch: DataFrame) -> DataFrame:
    """Counts by sentiment, by area and by priority with percent of the
    batch -- one GROUPING SETS pass instead of three scans."""
    grouped = batch.groupingSets(
        [["sentiment"], ["product_area"], ["priority"]], "sentiment", "product_area", "priority",
    ).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("cnt"))
    # Total = the rows of one grouping set (sentiment, NULL group included);
    # the grouped output is bounded by the three domains, so one pass suffices.
    total = F.sum(F.when(F.col("gid") == 3, F.col("cnt"))).over(Window.partitionBy())
    dim = (F.when(F.col("gid") == 3, F.lit("sentiment"))
           .when(F.col("gid") == 5, F.lit("product_area")).otherwise(F.lit("priority")))
    val = (F.when(F.col("gid") == 3, F.col("sentiment"))
           .when(F.col("gid") == 5, F.col("product_area")).otherwise(F.col("priority").cast("string")))
    return grouped.select("*", total.alias("total")).select(
        dim.alias("dimension"), val.alias("value"), F.col("cnt").alias("count"),
        (F.col("cnt") / F.col("total") * F.lit(100.0)).alias("percent"))


def ml_insights(account_scores: DataFrame, area_impact: DataFrame) -> DataFrame:
    """High-risk account count plus the top area, in one record."""
    high = account_scores.agg(F.count_if(F.col("risk_category").isin("high", "critical")).alias("high_risk_accounts"))
    top = top_n(area_impact, 1, "priority_score", ("product_area", "segment")).select(
        F.col("product_area").alias("top_priority_area"), F.col("priority_score").alias("top_priority_score"))
    # ``top`` has at most one row; a left join keeps the record when it is empty.
    return high.join(F.broadcast(top), how="left")


def top_n(df: DataFrame, n: int, by: str, keys=(), min_value: float | None = None) -> DataFrame:
    """T1-T4 (+P7): optional threshold, then the ``n`` largest by ``by``."""
    if min_value is not None:
        df = df.filter(F.col(by) >= F.lit(min_value))
    order = [F.col(by).desc()] + [F.col(k).asc_nulls_last() for k in keys]
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def top_risk_accounts(scores: DataFrame, n: int = TOP_ACCOUNTS) -> DataFrame:
    return top_n(scores, n, "churn_probability", ("account_id",))


def top_areas(scored: DataFrame, n: int = TOP_AREAS) -> DataFrame:
    return top_n(scored, n, "priority_score", ("product_area", "segment"))


def top_priorities(scored: DataFrame, n: int = TOP_PRIORITIES, min_score: float = PRIORITY_THRESHOLD) -> DataFrame:
    return top_n(scored, n, "priority_score", ("product_area", "segment"), min_value=min_score)


def high_risk_accounts(scores: DataFrame) -> DataFrame:
    """Accounts in the high or critical category, riskiest first."""
    return (scores.filter(F.col("risk_category").isin("high", "critical"))
            .orderBy(F.col("churn_probability").desc(), "account_id")
            .select("account_id", "health_score", "risk_category"))


def account_health(scores: DataFrame, account_id: str) -> DataFrame:
    """Point lookup of one account's prediction."""
    return scores.filter(F.col("account_id") == F.lit(account_id)).select(
        "account_id", "churn_probability", "health_score", "risk_category", "predicted_at", "model_version")
