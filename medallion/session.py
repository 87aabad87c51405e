"""Session construction and the shared scratch location.

Only session-level settings live here.  Everything that decides *how* a plan
runs (broadcast or sort-merge join, partition count after a shuffle, skew
splitting) is left to Catalyst and adaptive query execution, with the size
thresholds stated explicitly so that a broadcast is always behind a size check.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults.  The broadcast thresholds are the size check behind every
# broadcast in the library: no code path calls F.broadcast() on data whose size
# grows with the input; the planner broadcasts a side only when its estimated
# (planning) or measured (AQE, runtime) size is below these limits, and falls
# back to a sort-merge join with AQE skew splitting beyond them.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole documents (up to ~20k words) go through the optional pandas UDF:
    # keep Arrow batches to a bounded number of rows so one batch stays small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    app_name: str = "medallion",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library defaults.

    ``master`` is only set when given (on a cluster the launcher decides it).
    ``shuffle_partitions`` should be sized so that one post-shuffle partition
    holds roughly 128 MB at the target scale; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator to a location every executor can
    reach (HDFS, object store), and it is an error to leave it unset.  Only in
    local mode (tests, a laptop) do we create one of our own when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        # A folder on the driver's disk is not visible to the executors.
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="medallion-checkpoint-")
    spark.sparkContext.setCheckpointDir(local)
    return local


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/medallion/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has made so far; returns how many were there.

    Results that still read from them (every query with a written intermediate) must
    have been used by then, so this is the caller's to call.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``medallion`` importable in the Python workers of this session.

    The few places where Python runs inside tasks (the header reader, the
    optional NFKD accent stripper) call library functions; the workers must be
    able to import the package.  It is zipped once per driver process and added
    with ``addPyFile``, Spark's own way of shipping code to every executor
    (the same as ``--py-files``).  Calling it again is a no-op.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    if not _ZIP:
        package_dir = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="medallion-pyfiles-"), "medallion.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _, files in os.walk(package_dir):
                if "__pycache__" in folder:
                    continue
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, os.path.dirname(package_dir)))
        _ZIP.append(target)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(key)
