"""Independent semantics check: the feature and score rules re-derived in
pandas on a small fixture (sf0.001 feedback collected in the test only),
compared with the Spark operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from conftest import SMALL
from voxlens.config import AREA_WEIGHTS, DEFAULT_AS_OF
from voxlens.operators import features as feat
from voxlens.operators import scoring as sc
from voxlens.sources.tables import Tables

AS_OF = pd.Timestamp(DEFAULT_AS_OF)


@pytest.fixture(scope="module")
def fb(spark):
    pdf = Tables(spark, SMALL).feedback.toPandas()
    return pdf[pdf["created_at"] >= AS_OF - pd.Timedelta(days=90)].copy()


def _norm(s):
    lo, hi = s.min(), s.max()
    return pd.Series(0.5, index=s.index) if hi == lo else (s - lo) / (hi - lo)


def test_area_scores_match_pandas(spark, fb):
    g = fb.groupby(["product_area", "customer_tier"], dropna=False)
    a = pd.DataFrame({
        "feedback_count": g.size(),
        "feedback_last_7d": g["created_at"].apply(lambda s: (s > AS_OF - pd.Timedelta(days=7)).sum()),
        "negative_count": g["sentiment"].apply(lambda s: (s == "negative").sum()),
        "critical_count": g["priority"].apply(lambda s: (s >= 4).sum()),
        "p5_count": g["priority"].apply(lambda s: (s == 5).sum()),
        "unique_topics": g["topic"].nunique(),
        "regions_affected": g["region"].nunique(),
    }).reset_index().rename(columns={"customer_tier": "segment"})
    a["enterprise_flag"] = (a["segment"] == "enterprise").astype(int)
    score = 0
    for name, col, w in AREA_WEIGHTS:
        x = a[col] if col == "enterprise_flag" else _norm(a[col])
        score = score + x * w * 100
    a["priority_score"] = score
    a["risk_category"] = pd.cut(a["priority_score"], bins=[0, 30, 50, 70, 100],
                                labels=["low", "medium", "high", "critical"], include_lowest=True).astype(object)
    want = {(r.product_area, r.segment): (r.priority_score, r.risk_category, r.unique_topics, r.regions_affected)
            for r in a.itertuples()}
    got_df = sc.area_scores(feat.area_features(Tables(spark, SMALL).feedback))
    got = {(r.product_area, r.segment): (r.priority_score, r.risk_category, r.unique_topics, r.regions_affected)
           for r in got_df.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-9)
        assert got[k][1:] == tuple(None if (isinstance(v, float) and np.isnan(v)) else v for v in want[k][1:])


def test_account_features_match_pandas(spark, fb):
    g = fb.groupby(["customer_tier", "region"], dropna=False)
    a = pd.DataFrame({
        "total_feedback": g.size(),
        "negative_feedback": g["sentiment"].apply(lambda s: (s == "negative").sum()),
        "billing_issues": g["product_area"].apply(lambda s: (s == "billing").sum()),
        "last_feedback_date": g["created_at"].max(),
        "product_areas_mentioned": g["product_area"].nunique(),
        "avg_priority": g["priority"].mean(),
    }).reset_index().rename(columns={"customer_tier": "account_id"})
    a["negative_ratio"] = a["negative_feedback"] / (a["total_feedback"] + 1)
    a["days_since_last_feedback"] = (AS_OF - a["last_feedback_date"]).dt.days
    a["billing_issue_flag"] = (a["billing_issues"] > 0).astype(int)
    a["region_encoded"] = pd.Categorical(a["region"]).codes
    a["tier_encoded"] = a["account_id"].map({"free": 0, "pro": 1, "enterprise": 2}).fillna(0).astype(int)
    cols = ["negative_ratio", "days_since_last_feedback", "billing_issue_flag", "region_encoded", "tier_encoded",
            "product_areas_mentioned", "avg_priority"]
    want = {(r.account_id, None if pd.isna(r.region) else r.region): tuple(getattr(r, c) for c in cols)
            for r in a.itertuples()}
    got = {(r.account_id, r.region): tuple(r[c] for c in cols)
           for r in feat.account_features(Tables(spark, SMALL).feedback, grain="tier").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12)


def test_account_scores_match_pandas(spark):
    from voxlens.config import ACCOUNT_FEATURE_COLS, LINEAR_CHURN_BIAS, LINEAR_CHURN_WEIGHTS

    t = Tables(spark, SMALL)
    feats = feat.account_features(t.feedback, grain="user").toPandas().set_index("account_id")
    X = feats[list(ACCOUNT_FEATURE_COLS)].fillna(0).astype(float)
    std = X.std(ddof=0).where(lambda s: s > 1e-12, 1.0)  # population std, zero variance -> 1
    Z = (X - X.mean()) / std
    logit = LINEAR_CHURN_BIAS + sum(w * Z[c] for c, w in LINEAR_CHURN_WEIGHTS.items())
    p = 1 / (1 + np.exp(-logit))
    cat = np.select([p < 0.25, p < 0.5, p < 0.75], ["low", "medium", "high"], "critical")
    got = {r.account_id: r for r in sc.account_risk_scores(t.feedback).collect()}
    assert set(got) == set(p.index)
    for acct in p.index:
        assert got[acct].churn_probability == pytest.approx(p[acct], abs=1e-9)
        assert got[acct].health_score == pytest.approx((1 - p[acct]) * 100, abs=1e-7)
        assert got[acct].risk_category == cat[list(p.index).index(acct)]


@pytest.mark.parametrize("include_lowest", [True, False])
def test_area_bins_match_pandas_cut(spark, include_lowest):
    from voxlens.functions.scalars import area_bin

    rng = np.random.default_rng(5)
    values = list(rng.uniform(-10, 110, 400)) + [0.0, 30.0, 50.0, 70.0, 100.0, 100.00000000000001, -0.0,
                                                  30.000000000000004, 1e-300, -0.0001, -0.05]
    want = pd.cut(pd.Series(values), bins=[0, 30, 50, 70, 100], labels=["low", "medium", "high", "critical"],
                  include_lowest=include_lowest).astype(object).where(lambda s: s.notna(), None).tolist()
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, s double")
    got = [r.c for r in df.select("i", area_bin("s", include_lowest).alias("c")).orderBy("i").collect()]
    assert got == want
