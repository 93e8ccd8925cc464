"""Session helpers.

The library never creates a session behind the caller's back; ``local_session``
is for tests and the bench. ``prepare`` only sets what the operators rely on
(UTC session zone for whole-day arithmetic) and leaves everything else to the
cluster's configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the operators assume. Safe to call repeatedly.

    * UTC session zone (whole-day arithmetic on zone-less timestamps).
    * AQE skew handling even when splitting a skewed join partition needs an
      extra shuffle above it: the feature aggregates reuse the join's
      hash partitioning, and without the force flag AQE would leave a hot key
      (a third of the facts) in one task for both the join and the aggregate.
      With it, the hot partition is split and the partial (map-side)
      aggregate runs in the split tasks before the added exchange.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # e.g. Spark Connect: no driver-side context handle
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent (local tests) a scratch folder is created
    and registered; on a cluster the configured shared folder is always used.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) for "
                         "materialised stages; a machine-local folder is not safe on a cluster")
    local = tempfile.mkdtemp(prefix="voxlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "voxlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VOXLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture for error messages costs several driver round
        # trips per Column operation; off for tests and benchmarks.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # materialised stages are reliable checkpoints: delete them once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def materialize(df, name: str = "stage"):
    """Compute ``df`` once into a parquet folder under the shared folder
    (``spark.checkpoint.dir``) and return a DataFrame that reads it.

    Lineage is cut (a lost executor re-reads the files instead of recomputing
    upstream stages), several consumers share one computation, and later
    passes read only the columns they use. The application's folder is
    removed when the driver ends (or by ``release``).
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGE_ROOTS: dict[str, str] = {}


def _folder(spark: SparkSession, root: str):
    """The folder's file system and path on the JVM."""
    sc = _context(spark)
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path


def stage_root(spark: SparkSession) -> str:
    """This application's folder for materialised stages; its file system
    deletes it when the driver's JVM ends."""
    sc = _context(spark)
    app = sc.applicationId if sc is not None else spark.conf.get("spark.app.id")
    if app not in _STAGE_ROOTS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/voxlens-{app}"
        if sc is not None:
            fs, path = _folder(spark, root)
            fs.mkdirs(path)
            fs.deleteOnExit(path)
        _STAGE_ROOTS[app] = root
    return _STAGE_ROOTS[app]


def release(spark: SparkSession) -> None:
    """Remove this application's materialised stages now."""
    root = _STAGE_ROOTS.pop(_context(spark).applicationId, None)
    if root is not None:
        fs, path = _folder(spark, root)
        fs.delete(path, True)
