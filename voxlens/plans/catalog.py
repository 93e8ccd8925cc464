"""Registered queries: ``key -> (spark builder, DuckDB oracle SQL or None)``.

Each builder takes ``(spark, root)`` and returns a lazy DataFrame over the
whole tables under ``root``. Doubles whose value depends on an engine's
algorithm (exp/log, standard deviation, floating sums in arbitrary order)
are rounded to 6 places on both sides; integer, string and timestamp columns
are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.session import prepare
from voxlens.sources.tables import Tables

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, object | None]] = {}


def register(key: str, sql):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, root: str) -> DataFrame:
            prepare(spark)
            return fn(Tables(spark, root))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[key] = (run, sql)
        return fn

    return deco


def round6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the named double columns to 6 places (comparison form)."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: str(v[1]) for k, v in REGISTRY.items() if v[1] is not None}


def _load() -> None:
    # Import for the registration side effect.
    from voxlens.plans import queries as _  # noqa: F401
