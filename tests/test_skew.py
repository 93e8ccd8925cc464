"""A hot key holding a large share of the facts: the adapter join is split by
AQE and the features stay exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SMALL
from voxlens.operators import features as feat
from voxlens.sources.tables import Tables


class _SkewedTables(Tables):
    """The real tables, with events copied so that one user owns > 1/3 of them."""

    def __init__(self, spark, root, copies=6):
        super().__init__(spark, root)
        ev = Tables(spark, root).events
        hot = ev.where("user_id = 8")
        extra = [hot.withColumn("event_id", F.col("event_id") + F.lit(10_000_000 * (i + 1))) for i in range(copies)]
        for e in extra:
            ev = ev.unionByName(e)
        self.__dict__["events"] = ev


def test_hot_user_is_split_and_exact(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = _SkewedTables(spark, SMALL)
        total = t.events.count()
        assert t.events.where("user_id = 8").count() * 3 > total
        df = feat.account_base_features(t.feedback, grain="user")
        rows = {r.user_id: r for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        # exact against a plain per-user count over the same facts
        want = {r.user_id: r.n for r in feat.lookback(t.feedback).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n")).collect()}
        assert {u: r.total_feedback for u, r in rows.items()} == want
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
