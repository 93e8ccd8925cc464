"""What the operators of this subpackage share: session set-up, code shipping,
typed column helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import voxlens
from voxlens import session
from voxlens.session import prepare

#: Rows and bytes of one Arrow batch: bound a Python worker's memory when texts are long.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20

_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Settings the operators assume, and this package's code on every executor."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(voxlens.__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="voxlens-code-"), "voxlens_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("voxlens", os.path.relpath(full, root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SEEN: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """``session.materialize``; the rows are counted as they are written (``n_rows``)."""
    seen = Observation()
    out = session.materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    _SEEN[out] = seen
    return out


def n_rows(df: DataFrame) -> int:
    """The rows of ``df``; of a materialised stage as counted when it was written. A query for each such number
    would cost the driver memory: its plan, its jobs and the threads of its exchanges."""
    seen = _SEEN.get(df)
    return df.count() if seen is None else seen.get["n"]


def fresh(prefix: str = "vx") -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:12]}"


def crc_mod(column: Column, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod`` (NULL for a NULL)."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(mod)


def few(df: DataFrame, rows: int, each: int, joined: bool = False) -> DataFrame:
    """``df`` in a partition for each ``each`` of ``rows`` rows at most: a step on few rows does not pay for a task
    and a file of every shuffle partition. Many rows keep their partitions. ``joined`` rows are dealt anew, since
    the sorted sides of several joined partitions would stay in one task's memory until it ends."""
    n = max(1, -(-rows // each))
    if not joined:
        return df.coalesce(n)
    return df.repartition(n) if 2 * n <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def with_struct(df: DataFrame, fn, column: str, name: str) -> DataFrame:
    """All columns of ``df`` and the struct that ``fn`` makes from ``column``.

    The struct is made once: a filter on it is not pushed below the Python
    evaluation and evaluated again.
    """
    return df.select("*", fn(F.col(column)).alias(name))


__all__ = ["BATCH_ROWS", "crc_mod", "few", "fresh", "materialize", "n_rows", "ready", "table", "with_struct"]
