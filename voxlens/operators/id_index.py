"""A stored table with an index of its ids: insert-if-absent opens only data that may
conflict (S4).

The rows of each batch lie in ``batch_id=<n>``, clustered by the hash of their id into up to
``FILES`` files. Beside them, in the hidden folder ``_ids``, lies for each batch a
fingerprint (64-bit hash of the id) of every row with the file that holds it, in folders
by bucket of the fingerprint. An insert reads the index folders of the buckets that its ids fall into,
8 bytes a stored id, joins on the fingerprint, and opens only the data files that a match names; the ids
found there are compared in full, so equal fingerprints of different ids cost a look
and change nothing. A NULL id never conflicts and is not indexed.

The index of a batch is written after its rows, into its own folder in overwrite mode, so a replayed
batch replaces both. A batch without an index (its writer died, or it was stored otherwise) is probed
in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.operators import sinks
from voxlens.operators.logs import _file_system

#: Index buckets of a batch, and files that its rows are clustered into at most.
BUCKETS = 16
FILES = 16

_INDEX = "fingerprint long, file string, batch_id long, bucket int"


def fingerprint(column) -> F.Column:
    return F.xxhash64(column)


def _bucket(mark: F.Column) -> F.Column:
    return F.pmod(mark, F.lit(BUCKETS)).cast("int")


def _batches(spark: SparkSession, path: str) -> set[int]:
    """The numbers of the batches stored under a folder."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return {int(n[9:]) for n in names if n.startswith("batch_id=") and n[9:].isdigit()}


def store(rows: DataFrame, path: str, batch_id: int, key: str = "id", files: int = FILES) -> None:
    """Write a batch and then its index."""
    spark, root = rows.sparkSession, path.rstrip("/")
    rows.repartition(files, F.pmod(fingerprint(key), F.lit(files))).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
    kind = rows.schema[key].dataType.simpleString()
    stored = spark.read.schema(f"`{key}` {kind}").parquet(f"{root}/batch_id={batch_id}").where(F.col(key).isNotNull())
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    marks = stored.select(fingerprint(key).alias("fingerprint"), name.alias("file"))
    marks.withColumn("bucket", _bucket(F.col("fingerprint"))).write.mode("overwrite").partitionBy("bucket") \
        .parquet(f"{root}/_ids/batch_id={batch_id}")


def candidate_files(ids: DataFrame, path: str, key: str = "id", exclude_batch: int | None = None) -> list[str]:
    """The data files under ``path`` that may hold one of ``ids``: those that a fingerprint
    names, and all of batches that have no index."""
    spark, root = ids.sparkSession, path.rstrip("/")
    batches = _batches(spark, root) - {exclude_batch}
    indexed = _batches(spark, f"{root}/_ids") & batches
    found = [f"{root}/batch_id={b}" for b in sorted(batches - indexed)]
    if not indexed:
        return found
    wanted = ids.select(fingerprint(key).alias("fingerprint")).distinct()
    buckets = sorted(r[0] for r in wanted.select(_bucket(F.col("fingerprint"))).distinct().collect())
    index = spark.read.schema(_INDEX).option("basePath", f"{root}/_ids").parquet(
        *[f"{root}/_ids/batch_id={b}" for b in sorted(indexed)])
    hits = index.where(F.col("bucket").isin(buckets)).join(wanted, "fingerprint", "left_semi") \
        .select("batch_id", "file").distinct().collect()
    return found + sorted(f"{root}/batch_id={r.batch_id}/{r.file}" for r in hits)


def conflicts(ids: DataFrame, path: str, key: str = "id", exclude_batch: int | None = None) -> DataFrame:
    """The distinct ``ids`` (one column, not NULL) that are stored under ``path``."""
    files = candidate_files(ids, path, key, exclude_batch)
    if not files:
        return ids.limit(0)
    kind = ids.schema[key].dataType.simpleString()
    stored = ids.sparkSession.read.schema(f"`{key}` {kind}").parquet(*files)
    return stored.join(ids, key, "left_semi").distinct()


def insert(batch: DataFrame, path: str, batch_id: int, key: str = "id", order_col: str | None = None,
           files: int = FILES) -> None:
    """Store the rows of ``batch`` whose id no other batch holds, as batch ``batch_id``."""
    ids = batch.select(key).where(F.col(key).isNotNull()).distinct()
    store(sinks.insert_if_absent(conflicts(ids, path, key, batch_id), batch, key, order_col), path, batch_id, key, files)
