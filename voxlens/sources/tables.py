"""Base-table readers.

Tables are plain parquet datasets addressed by name under one root. Reads
are lazy; Catalyst prunes columns and pushes filters into the scan, so callers
just select what they need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one parquet table ``{root}/{name}.parquet`` (file or directory)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
              properties: dict | None = None) -> DataFrame:
    """Partitioned JDBC read of a relational table (the reference's only store)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()


class Tables:
    """Lazy handle on the base tables of one dataset root.

    A table is resolved once per handle; a new handle lists the files anew, so
    a long-lived session sees what has been appended meanwhile.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            df = read_table(self.spark, self.root, name)
            setattr(self, name, df)
            return df
        raise AttributeError(name)

    @cached_property
    def feedback(self) -> DataFrame:
        from voxlens.sources.adapters import feedback_enriched

        return feedback_enriched(self)

    @cached_property
    def feedback_core(self) -> DataFrame:
        """Feedback without customer attributes (no fact-side join)."""
        from voxlens.sources.adapters import feedback_core

        return feedback_core(self)

    @cached_property
    def model_versions(self) -> DataFrame:
        from voxlens.sources.adapters import model_versions

        return model_versions(self)

    @cached_property
    def model_metrics(self) -> DataFrame:
        from voxlens.sources.adapters import model_metrics

        return model_metrics(self)

    @cached_property
    def model_deployments(self) -> DataFrame:
        """One row per model type, read by most registry rules: materialised
        once so the version scan behind it is not repeated per consumer."""
        from voxlens.session import materialize
        from voxlens.sources.adapters import model_deployments

        return materialize(model_deployments(self), "model_deployments")

    @cached_property
    def prediction_history(self) -> DataFrame:
        from voxlens.sources.adapters import prediction_distribution_history

        return prediction_distribution_history(self)

    @cached_property
    def deployment_log(self) -> DataFrame:
        from voxlens.sources.adapters import deployment_log

        return deployment_log(self)

    @cached_property
    def run_starts(self) -> DataFrame:
        from voxlens.sources.adapters import run_starts

        return run_starts(self)

    @cached_property
    def run_ends(self) -> DataFrame:
        from voxlens.sources.adapters import run_ends

        return run_ends(self)
