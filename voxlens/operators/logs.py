"""Append-only logs that several jobs may write at once (S5), and numbers that no two
jobs get (L6).

A log is a folder of entries, ``entry=<n>``. An append writes its rows to a hidden
folder first, then claims the next number, then renames: readers see a whole entry or
none, two appends never share a folder, and the numbers tell the order in which
appends were committed. A number is claimed by creating its marker file without
overwriting (``FileSystem.create(path, overwrite=false)``, atomic on HDFS and on stores
with conditional creation; ``File.createNewFile`` on a local disk); whoever finds it there takes the next. A job that dies leaves a
hidden folder or a gap in the numbers, never half an entry.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: The partition column that holds an entry's number.
ENTRY = "entry"


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def _child(spark: SparkSession, folder: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists already."""
    from py4j.protocol import Py4JJavaError

    fs, marker = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":  # there Hadoop looks first and creates then
        return spark.sparkContext._jvm.java.io.File(marker.toUri().getPath()).createNewFile()
    try:
        fs.create(marker, False).close()
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def claim(spark: SparkSession, folder: str, name: str, first: int = 1) -> int:
    """The smallest number from ``first`` on, and above all claimed ones, that this call
    alone has claimed for ``name`` in ``folder``."""
    claims = f"{folder.rstrip('/')}/_claims/{name}"
    fs, path = _file_system(spark, claims)
    fs.mkdirs(path)
    taken = [int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit()]
    number = max([first - 1, *taken]) + 1
    while not create_marker(spark, f"{claims}/{number}"):
        number += 1
    return number


def append(df: DataFrame, base_path: str, table: str, partition_by=None) -> int:
    """Commit ``df`` as the next entry of the log; its number."""
    spark = df.sparkSession
    folder = f"{base_path.rstrip('/')}/{table}"
    staged = f"{folder}/_staged/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    number = claim(spark, folder, "entries")
    fs, source = _file_system(spark, staged)
    if not fs.rename(source, _child(spark, folder, f"{ENTRY}={number}")):
        raise OSError(f"entry {number} of {folder} could not be committed")
    return number


def read(spark: SparkSession, base_path: str, table: str, schema: str) -> DataFrame:
    """The rows of the log with the number of their entry (long); empty where
    nothing has been committed."""
    path = f"{base_path.rstrip('/')}/{table}"
    try:
        return spark.read.schema(f"{schema}, {ENTRY} long").parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, {ENTRY} long")
