"""Sinks: keyed upsert (S3/S7), insert-if-absent (S4), constraint checks (S6),
table counts (S10) and snapshot writes (S5).

Upserts are pure functions ``(existing, incoming) -> new table``; writers put
the result in a new snapshot directory and never overwrite a path that is
being read, so a failed or retried job leaves the previous snapshot intact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.config import RISK_CATEGORIES
from voxlens.operators import logs


def _latest_per_key(df: DataFrame, keys, order_col: str | None, take_max: bool = True) -> DataFrame:
    """One row per non-NULL key, chosen deterministically by a struct max/min
    (a partial aggregate, so a hot key is combined map-side). Rows with a NULL
    key component are kept as they are: NULL never conflicts."""
    cols = [c for c in df.columns if c not in keys]
    pick = F.struct(*([order_col] if order_col in cols else []), *[c for c in cols if c != order_col])
    agg = F.max(pick) if take_max else F.min(pick)
    has_null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dedup = (df.where(~has_null_key).groupBy(*keys).agg(agg.alias("_p"))
             .select(*keys, *[F.col(f"_p.{c}").alias(c) for c in cols]))
    return dedup.unionByName(df.where(has_null_key).select(*keys, *cols))


def upsert(existing: DataFrame, incoming: DataFrame, keys, update_cols, order_col: str | None = None,
           unique_keys: bool = False) -> DataFrame:
    """S3: ``INSERT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c``.

    * duplicate incoming keys collapse to one row (the largest ``order_col``,
      then the largest row), since a set-based MERGE must not match twice
      (``unique_keys``: the caller's keys are unique, e.g. an aggregate's, and
      this pass is left out);
    * on conflict, ``update_cols`` take the incoming value even when it is
      NULL (a presence flag, not ``coalesce``); other columns keep the old value;
    * keys only in ``incoming`` are inserted, keys only in ``existing`` kept;
    * NULL keys never conflict.
    """
    keys, update_cols = list(keys), list(update_cols)
    cols = existing.columns
    inc = incoming.select(*cols) if unique_keys else _latest_per_key(incoming.select(*cols), keys, order_col)
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in cols if c not in keys], F.lit(True).alias("_old"))
    new = inc.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cols if c not in keys], F.lit(True).alias("_new"))
    j = old.join(new, keys, "full_outer")
    hit = F.coalesce(F.col("_new"), F.lit(False))
    both = hit & F.coalesce(F.col("_old"), F.lit(False))
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c))
        else:
            out.append(F.when(both | ~hit, F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}")).alias(c))
    return j.select(*out)


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: str = "id", order_col: str | None = None) -> DataFrame:
    """``ON CONFLICT (key) DO NOTHING``; returns the rows that would be
    inserted (their count is the reference's return value). Within the batch
    the first row per key wins (smallest ``order_col``, then smallest row)."""
    ids = batch.select(key).where(F.col(key).isNotNull()).distinct()
    conflicts = existing.select(key).join(ids, key, "left_semi").distinct()  # the stored table is only probed
    first = _latest_per_key(batch, [key], order_col, take_max=False)
    return first.join(conflicts, key, "left_anti").select(*batch.columns)


def constraint_violations(df: DataFrame, table_name: str, keys, not_null=(), checks=None) -> DataFrame:
    """One ``(table_name, rule, key)`` row per violated rule.

    CHECK predicates pass on NULL (SQL semantics); NOT NULL is separate.
    Uniqueness is a ``groupBy(keys).count() > 1`` (partial aggregate).
    """
    checks = checks or {}
    key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    rules = [F.when(F.col(c).isNull(), F.lit(f"not_null_{c}")) for c in not_null]
    rules += [F.when(~F.coalesce(pred, F.lit(True)), F.lit(name)) for name, pred in checks.items()]
    failed = F.filter(F.array(*rules), lambda x: x.isNotNull())
    row_level = df.select(key_text.alias("key"), F.explode(failed).alias("rule"))
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .select(key_text.alias("key"), F.lit("unique_key").alias("rule")))
    return row_level.unionByName(dup).select(F.lit(table_name).alias("table_name"), "rule", "key")


def account_score_violations(scores: DataFrame) -> DataFrame:
    p, h = F.col("churn_probability"), F.col("health_score")
    return constraint_violations(
        scores, "account_risk_scores", ["account_id"],
        not_null=["account_id", "churn_probability", "health_score", "risk_category", "predicted_at",
                  "model_version"],
        checks={"churn_probability_range": (p >= 0) & (p <= 1),
                "health_score_range": (h >= 0) & (h <= 100),
                "risk_category_domain": F.col("risk_category").isin(*RISK_CATEGORIES)})


def area_impact_violations(impact: DataFrame) -> DataFrame:
    s, a = F.col("priority_score"), F.col("avg_sentiment_score")
    return constraint_violations(
        impact, "product_area_impact", ["product_area", "segment"],
        not_null=["product_area", "segment", "priority_score", "feedback_count", "avg_sentiment_score",
                  "negative_count", "critical_count", "predicted_at", "model_version"],
        checks={"priority_score_range": (s >= 0) & (s <= 100),
                "feedback_count_range": F.col("feedback_count") >= 0,
                "avg_sentiment_score_range": (a >= -1) & (a <= 1),
                "negative_count_range": F.col("negative_count") >= 0,
                "critical_count_range": F.col("critical_count") >= 0})


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table, one union."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def write_snapshot(df: DataFrame, base_path: str, table: str, snapshot_id: str,
                   partition_by=None, mode: str = "errorifexists") -> str:
    """Write ``df`` to ``{base}/{table}/snapshot={id}`` as parquet.

    A new directory per snapshot: readers of the previous snapshot are never
    disturbed and a retried job simply rewrites its own directory.
    """
    path = f"{base_path.rstrip('/')}/{table}/snapshot={snapshot_id}"
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_feedback(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Store the feedback facts partitioned by ``created_date`` so lookback
    filters prune partitions (see ``features.lookback``).

    Rows are clustered by date with a ``REBALANCE`` hint rather than a plain
    ``repartition``: each task writes few date directories, and AQE splits a
    hot date (a third of the rows) across tasks instead of one writer."""
    (df.withColumn("created_date", F.to_date("created_at"))
     .hint("rebalance", "created_date")
     .write.mode(mode).partitionBy("created_date").parquet(path))
    return path


def append_log(df: DataFrame, base_path: str, table: str, partition_by=None) -> str:
    """One entry of an append-only log (see ``operators.logs``); the log's folder."""
    logs.append(df, base_path, table, partition_by)
    return f"{base_path.rstrip('/')}/{table}"


def read_snapshot(spark: SparkSession, base_path: str, table: str, snapshot_id: str) -> DataFrame:
    return spark.read.parquet(f"{base_path.rstrip('/')}/{table}/snapshot={snapshot_id}")
