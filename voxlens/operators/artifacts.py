"""Stored artifacts (S8): fitted pipeline, scaler, region codes, rule weights.

An artifact lives in a folder of its own under ``{base}/{model_type}/{version}``.
Reading one that was never written gives ``None`` (the callers' defaults); any
other failure to read is raised."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from voxlens.operators import learn, scoring


def folder(base: str, model_type: str, version: str) -> str:
    return f"{base.rstrip('/')}/models/{model_type}/{version}"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_churn(path: str, model, scaler: DataFrame, codes: DataFrame) -> str:
    """Pipeline, scaler row and region codes of one version."""
    learn.save_model(model, f"{path}/pipeline")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    codes.write.mode("overwrite").parquet(f"{path}/region_codes")
    return path


def load_scaler(spark: SparkSession, path: str) -> DataFrame | None:
    return read_or_none(spark, f"{path}/scaler")


def load_codes(spark: SparkSession, path: str) -> DataFrame | None:
    return read_or_none(spark, f"{path}/region_codes")


def load_pipeline(spark: SparkSession, path: str):
    return None if read_or_none(spark, f"{path}/scaler") is None else learn.load_model(f"{path}/pipeline")


def save_weights(weights: DataFrame, path: str) -> str:
    """Rule weights (name, weight) of the area scorer."""
    weights.select("name", "weight").write.mode("overwrite").parquet(f"{path}/weights")
    return path


def load_weights(spark: SparkSession, path: str) -> DataFrame:
    """Stored weights over the defaults; the defaults alone where none are stored."""
    return scoring.effective_weights(scoring.default_weights(spark), read_or_none(spark, f"{path}/weights"))
