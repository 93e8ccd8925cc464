"""Keyed snapshots in hash buckets: an upsert costs what its patch touches.

A snapshot is a manifest, one row per bucket with the folders that hold the bucket's rows, the
bucket being the hash of the keys modulo a number fixed when the table is first written. An
upsert reads the buckets that the patch's keys fall into, writes those anew, and refers
to the old folders for all others. Folders are written once and never changed; a
manifest is renamed into place when its data are complete, so a reader sees the old snapshot
or the new one, and a failed upsert leaves unnamed folders only.

Scale: choose the number of buckets for about 128 MB of rows each. What comes to the driver are
bucket numbers and folders, one row per bucket. NULL keys hash like any value and never
conflict (``sinks.upsert``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.operators import sinks
from voxlens.operators.logs import _child, _file_system

#: Buckets of a table whose size is not known (the number stays with the table).
BUCKETS = 64
BUCKET = "__bucket"

_MANIFEST = "bucket int, path string, rows long, n_buckets int, keys array<string>, schema string"


def bucket_of(keys, n_buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def _folder(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def manifest(spark: SparkSession, base: str, table: str, snapshot: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{_folder(base, table)}/manifest={snapshot}")


def _write_data(df: DataFrame, base: str, table: str, keys, n_buckets: int) -> list[tuple[int, str, int]]:
    """The rows in folders by bucket: (bucket, folder, rows) of those that have any."""
    path = f"{_folder(base, table)}/_data/{uuid.uuid4().hex}"
    marked = df.withColumn(BUCKET, bucket_of(keys, n_buckets))
    marked.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    found = df.sparkSession.read.schema(f"{BUCKET} int").parquet(path).groupBy(BUCKET).agg(F.count("*").alias("n")).collect()
    return [(r[BUCKET], f"{path}/{BUCKET}={r[BUCKET]}", r.n) for r in found]


def _commit(spark: SparkSession, base: str, table: str, snapshot: str, parts, n_buckets: int, keys, schema: str) -> str:
    """Name a snapshot: its manifest appears at once or not at all."""
    folder = _folder(base, table)
    staged = f"{folder}/_manifests/{uuid.uuid4().hex}"
    rows = [(b, p, n, n_buckets, list(keys), schema) for b, p, n in sorted(parts)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(staged)
    fs, source = _file_system(spark, staged)
    target = _child(spark, folder, f"manifest={snapshot}")
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(f"{folder}/manifest={snapshot}")
    return f"{folder}/manifest={snapshot}"


def write(df: DataFrame, base: str, table: str, snapshot: str, keys, n_buckets: int = BUCKETS) -> str:
    """The first snapshot of a table; its manifest's folder."""
    keys = list(keys)
    parts = _write_data(df, base, table, keys, n_buckets)
    parts += [(-1, "", 0)]  # carries the schema, also of an empty table
    return _commit(df.sparkSession, base, table, snapshot, parts, n_buckets, keys, df.schema.json())


def _read_paths(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(*paths) if paths else spark.createDataFrame([], kind)


def read(spark: SparkSession, base: str, table: str, snapshot: str) -> DataFrame:
    """The rows of a snapshot."""
    parts = manifest(spark, base, table, snapshot).collect()
    return _read_paths(spark, [r.path for r in parts if r.bucket >= 0], parts[0].schema)


def upsert(patch: DataFrame, base: str, table: str, previous: str, snapshot: str, update_cols, order_col: str | None = None,
           unique_keys: bool = False) -> list[int]:
    """S3: snapshot ``snapshot`` = ``previous`` with ``patch`` upserted; the buckets written.

    The rows are those of ``sinks.upsert`` over the whole table."""
    spark = patch.sparkSession
    parts = manifest(spark, base, table, previous).collect()
    keys, n_buckets, schema = list(parts[0]["keys"]), parts[0].n_buckets, parts[0].schema
    touched = {r[0] for r in patch.select(bucket_of(keys, n_buckets)).distinct().collect()}
    old = _read_paths(spark, [r.path for r in parts if r.bucket in touched], schema)
    columns = [f.name for f in T.StructType.fromJson(json.loads(schema)).fields]
    new = sinks.upsert(old, patch.select(*columns), keys, update_cols, order_col, unique_keys)
    written = _write_data(new.select(*columns), base, table, keys, n_buckets) if touched else []
    kept = [(r.bucket, r.path, r.rows) for r in parts if r.bucket not in touched]
    _commit(spark, base, table, snapshot, kept + written, n_buckets, keys, schema)
    return sorted(b for b, _, _ in written)
