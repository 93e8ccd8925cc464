"""Operators in the form meant for large tables, against their plain definition."""

from __future__ import annotations

import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from voxlens.operators import daily, features, learn, reports, scoring, sinks
from voxlens.sources.tables import Tables


# A2: one aggregate


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_area_features_take_one_aggregate_shuffle_and_no_expand(spark):
    feedback = Tables(spark, SMALL).feedback
    plan = plan_of(features.area_features(feedback))
    assert "Expand" not in plan and plan.count("hashpartitioning(product_area") == 1
    impact = scoring.product_area_impact(feedback)  # reads neither distinct count
    assert "collect_set" not in plan_of(impact) and "Expand" not in plan_of(impact)


@pytest.mark.parametrize("parts", [2, 16])
def test_topics_dealt_into_parts_count_the_same(spark, parts):
    feedback = Tables(spark, SMALL).feedback.withColumn("topic", F.when(F.length("topic") % 5 != 0, F.col("topic")))
    whole, dealt = (features.area_base_features(feedback, topic_parts=n) for n in (1, parts))
    assert sorted(map(str, whole.collect())) == sorted(map(str, dealt.select(*whole.columns).collect()))


# A5: exact selection


def values(spark, numbers):
    return spark.createDataFrame([(None if v is None else float(v),) for v in numbers], "x double").repartition(5)


@pytest.mark.parametrize("name", ["plain", "ties", "spread", "nulls", "two", "one"])
def test_quantiles_by_selection_are_exact(spark, name):
    rng = random.Random(5)
    numbers = {"plain": [rng.random() for _ in range(3000)], "ties": [7.0] * 2000 + [rng.random() * 20 for _ in range(1000)],
               "spread": [rng.choice([1, -1]) * 10.0 ** rng.randrange(-200, 200) for _ in range(2000)],
               "nulls": [None] * 500 + [rng.gauss(0, 1) for _ in range(1500)], "two": [2.0, 1.0], "one": [4.0]}[name]
    kept = np.array([v for v in numbers if v is not None])
    for rows in (1, 40, 10_000):
        row = reports.score_distribution(values(spark, numbers), "x", rows=rows).first()
        assert row.n == len(numbers)
        want = [np.quantile(kept, q) for q in (0, 0.25, 0.5, 0.75, 1)]
        assert [row.min_score, row.q1_score, row.median_score, row.q3_score, row.max_score] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("accuracy", [3, 20])
def test_a_coarse_sketch_still_ends_and_is_exact(spark, accuracy):
    rng = random.Random(6)
    numbers = sorted(round(rng.random() * 50) for _ in range(2000))
    ranks = [0, 1, 499, 500, 1000, 1998, 1999]
    got = reports.order_statistics(values(spark, numbers), "x", ranks, len(numbers), rows=10, accuracy=accuracy)
    assert got == {r: float(numbers[r]) for r in ranks}


def test_distribution_of_nothing(spark):
    row = reports.score_distribution(values(spark, []), "x").first()
    assert row.n == 0 and row.median_score is None
    row = reports.score_distribution(values(spark, [None, None]), "x").first()
    assert row.n == 2 and row.q1_score is None


# A1 from daily partials


@pytest.mark.parametrize("grain", ["user", "tier"])
@pytest.mark.parametrize("as_of", [None, "2024-01-20 13:37:11", "2023-12-01 00:00:00", "2024-03-01 23:59:59"])
def test_daily_partials_equal_the_fact_scan(spark, grain, as_of):
    feedback = Tables(spark, SMALL).feedback
    # rows on the bounds themselves: 30 and 7 days are strict, 90 is not
    edge = feedback.orderBy("id").limit(6).withColumn("created_at", F.element_at(F.array(*[
        F.expr(f"TIMESTAMP_NTZ '{as_of or '2024-01-31 00:00:00'}' - INTERVAL {d} DAYS {s} SECONDS")
        for d in (90, 30, 7) for s in (0, 1)]), F.pmod(F.xxhash64("id"), F.lit(6)).cast("int") + 1))
    feedback = feedback.unionByName(edge)
    base = tempfile.mkdtemp(prefix="voxlens-daily-")
    facts = spark.read.parquet(sinks.write_feedback(feedback, f"{base}/facts"))
    stored = spark.read.parquet(daily.add_days(facts, f"{base}/daily", grain))
    want = features.account_base_features(feedback, as_of, grain=grain)
    got = daily.account_base_features(stored, facts, as_of, grain=grain)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_new_days_are_added_alone_and_facts_are_pruned(spark):
    feedback = Tables(spark, SMALL).feedback
    base = tempfile.mkdtemp(prefix="voxlens-days-")
    facts = spark.read.parquet(sinks.write_feedback(feedback, f"{base}/facts"))
    early = facts.where("created_date <= DATE '2023-12-31'")
    daily.add_days(early, f"{base}/daily")
    first = {f for f in spark.read.parquet(f"{base}/daily").inputFiles()}
    daily.add_days(facts, f"{base}/daily", since="2023-12-31")
    stored = spark.read.parquet(f"{base}/daily")
    assert first < set(stored.inputFiles())
    got = daily.account_base_features(stored, facts)
    want = features.account_base_features(feedback, grain="user")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    scans = [line for line in plan_of(got).splitlines() if "PartitionFilters" in line]
    assert len(scans) == 2 and all("created_date" in line.split("PartitionFilters")[1].split("PushedFilters")[0] for line in scans)


# M4


def test_the_gradient_tells_a_solution_from_another_point(spark):
    t = Tables(spark, MEDIUM)
    feats = features.account_features(t.feedback, grain="user")
    data = scoring.standardize(features.feature_matrix(learn.synthetic_labels(feats), keys=("account_id", "churned")),
                               keys=("account_id", "churned")).cache()
    model = learn.fit_churn_classifier(data)
    assert learn.optimality(model, data).first().max_abs_gradient < 1e-5
    assert learn.optimality(model, data.where("total_feedback > 0")).first().max_abs_gradient > 1e-3
