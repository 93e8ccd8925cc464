"""Scalar column expressions (all JVM-side, codegen'd; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlens.config import (
    AREA_BIN_EDGES,
    AREA_BIN_LABELS,
    CHURN_BUCKET_EDGES,
    CHURN_BUCKET_LABELS,
    RISK_CATEGORIES,
    TIER_CODES,
)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def smoothed_ratio(num, den) -> Column:
    """``num / (den + 1)`` as double (never divides by zero for counts)."""
    return col(num).cast("double") / (col(den) + F.lit(1))


def tier_code(tier) -> Column:
    """free 0, pro 1, enterprise 2; anything else or NULL 0."""
    c = col(tier)
    expr = None
    for name, code in TIER_CODES.items():
        expr = F.when(c == name, F.lit(code)) if expr is None else expr.when(c == name, F.lit(code))
    return expr.otherwise(F.lit(0))


def indicator(predicate: Column) -> Column:
    """0/1 int from a predicate; NULL counts as 0."""
    return F.coalesce(predicate.cast("int"), F.lit(0))


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def churn_bucket(p) -> Column:
    """Left-closed probability buckets; NaN falls through to the top bucket, NULL stays NULL."""
    c = col(p)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(CHURN_BUCKET_EDGES, CHURN_BUCKET_LABELS):
        expr = expr.when(~F.isnan(c) & (c < F.lit(edge)), F.lit(label))
    return expr.otherwise(F.lit(CHURN_BUCKET_LABELS[-1]))


def area_bin(score, include_lowest: bool = True) -> Column:
    """Right-closed bins (0,30] (30,50] (50,70] (70,100]; outside (or NaN) -> NULL.

    ``include_lowest`` closes the first bin on the left as well, so 0 is "low".
    """
    c = col(score)
    lo = AREA_BIN_EDGES[0]
    first = ((c >= F.lit(lo)) if include_lowest else (c > F.lit(lo))) & (c <= F.lit(AREA_BIN_EDGES[1]))
    expr = F.when(F.isnan(c), F.lit(None).cast("string")).when(first, F.lit(AREA_BIN_LABELS[0]))
    for left, right, label in zip(AREA_BIN_EDGES[1:-1], AREA_BIN_EDGES[2:], AREA_BIN_LABELS[1:]):
        expr = expr.when((c > F.lit(left)) & (c <= F.lit(right)), F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def category_rank(category) -> Column:
    """Sort rank of a risk category (bin order), NULL last."""
    c = col(category)
    expr = None
    for i, name in enumerate(RISK_CATEGORIES):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr.otherwise(F.lit(len(RISK_CATEGORIES)))


def min_max(value, lo, hi) -> Column:
    """Min-max normalisation; a constant column maps to 0.5."""
    v, a, b = col(value), col(lo), col(hi)
    return F.when(b == a, F.lit(0.5)).otherwise((v - a).cast("double") / (b - a))


def relative_improvement(new, prev) -> Column:
    """``(new - prev) / prev`` when prev > 0, else ``new``."""
    n, p = col(new), col(prev)
    return F.when(p > 0, (n - p) / p).otherwise(n)


def abs_relative_change(recent, older) -> Column:
    """``|recent - older| / |older|``; NULL when older is 0."""
    r, o = col(recent), col(older)
    return F.when(o != 0, F.abs((r - o) / o))


def version_major(version) -> Column:
    """Leading integer of a version string: ``v12.1`` -> 12, ``7`` -> 7, garbage -> NULL."""
    digits = F.regexp_extract(col(version), r"^v?([0-9]+)(\.|$)", 1)
    return F.when(digits != "", digits.cast("long"))


def fixed_1dp(x) -> Column:
    """Text with one decimal, half-up, via integer arithmetic (engine independent)."""
    tenths = F.floor(col(x) * F.lit(10) + F.lit(0.5)).cast("long")
    return F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"))


def percent_2dp(x) -> Column:
    """``x`` as a percent with two decimals (``0.66`` -> ``66.00%``), half-up."""
    hundredths = F.floor(col(x) * F.lit(10000) + F.lit(0.5)).cast("long")
    return F.concat((hundredths / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((hundredths % 100).cast("string"), 2, "0"), F.lit("%"))
