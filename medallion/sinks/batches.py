"""Batches that are added to a table once and whole (K3, K6, K8).

The reference appends to its target and commits at the end; running it again doubles the rows.
Here a table has a ledger of its batches:

* Rows are staged first: ``<table>/data/batch=<name>/attempt=<id>/``, a folder that no reader
  looks at yet.  A job that dies leaves a folder that is never read.
* The commit is one small ledger file, ``<table>/ledger/<name>.json``, made only if there is
  none: the file system lets one writer win, so two runs of a batch cannot both count.  It names the attempt.
* Writing a batch that the ledger has is a no-op; its rows are not even computed.

Readers take the attempts that the ledger names.  Further partition columns stay partition
columns, so filters on them still prune folders.

For a relational target the same protocol is a staging table, a ledger table and one
transaction; ``jdbc_batch_statements`` gives its statements.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

LEDGER = "batch string, attempt string, rows bigint, sequence bigint"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def _check(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"batch names are letters, digits, '_', '.' and '-': {name!r}")
    return name


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path: the same store that Spark's readers use."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; whether this call made it."""
    fs, p = _file_system(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """(batch, attempt, rows, sequence) of every committed batch, read by Spark."""
    folder = f"{table.rstrip('/')}/ledger"
    fs, p = _file_system(spark, folder)
    return spark.read.schema(LEDGER).json(folder) if fs.exists(p) else spark.createDataFrame([], LEDGER)


def committed(spark: SparkSession, table: str) -> list[Row]:
    """The ledger's rows in the order of their commits: one small row for each batch."""
    return sorted(ledger(spark, table).collect(), key=lambda r: (r["sequence"], r["batch"]))


def write_batch(df: DataFrame, table: str, batch: str, partition_by: Sequence[str] = ()) -> bool:
    """Add a batch to the table, once; False if the ledger had it already."""
    spark, table = df.sparkSession, table.rstrip("/")
    done = committed(spark, table)
    if any(r["batch"] == _check(batch) for r in done):
        return False
    attempt = uuid.uuid4().hex
    folder = f"{table}/data/batch={batch}/attempt={attempt}"
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(folder)
    entry = {"batch": batch, "attempt": attempt, "rows": spark.read.schema(df.schema).parquet(folder).count(), "sequence": len(done)}
    return create_once(spark, f"{table}/ledger/{batch}.json", json.dumps(entry))


def read_batches(spark: SparkSession, table: str, schema: str, batches: Sequence[str] | None = None) -> DataFrame:
    """The rows of all committed batches (or of those named), with the column ``batch``.

    ``schema`` is that of the rows; partition columns keep the types it gives them.
    """
    table = table.rstrip("/")
    paths = [f"{table}/data/batch={r['batch']}/attempt={r['attempt']}" for r in committed(spark, table) if batches is None or r["batch"] in batches]
    full = f"{schema}, batch string, attempt string"
    if not paths:
        return spark.createDataFrame([], full).drop("attempt")
    return spark.read.schema(full).option("basePath", f"{table}/data").parquet(*paths).drop("attempt")


def batch_counts(spark: SparkSession, table: str) -> DataFrame:
    """R2 for batches: rows that each commit recorded."""
    return ledger(spark, table).select("batch", F.col("rows").alias("total"))


def _quoted(name: str) -> str:
    return ".".join(f'"{part}"' for part in name.replace('"', '""').split("."))


def jdbc_batch_statements(target: str, staging: str, ledger_table: str, batch: str, columns: Sequence[str]) -> list[str]:
    """K6/K8 in one transaction: statements that move a staged batch into the target, once.

    The staging table is filled by ``write_jdbc`` (``overwrite``) from the executors.  These
    statements then run on one connection with auto-commit off.  The ledger's primary key is its ``batch``: a second
    run's first statement fails on it, or finds the batch and moves nothing.
    """
    names, value = ", ".join(map(_quoted, columns)), _check(batch)
    return [
        f"INSERT INTO {_quoted(ledger_table)} (batch, total) SELECT '{value}', COUNT(*) FROM {_quoted(staging)}",
        f"INSERT INTO {_quoted(target)} ({names}) SELECT {names} FROM {_quoted(staging)}",
    ]


def commit_jdbc_batch(spark: SparkSession, url: str, batch: str, target: str, staging: str, ledger_table: str, columns: Sequence[str],
                      properties: dict[str, str] | None = None) -> bool:
    """Run the statements of ``jdbc_batch_statements`` as one transaction; False if the ledger has the batch."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        if statement.executeQuery(f"SELECT batch FROM {_quoted(ledger_table)} WHERE batch = '{_check(batch)}'").next():
            return False
        for sql in jdbc_batch_statements(target, staging, ledger_table, batch, columns):
            statement.executeUpdate(sql)
        connection.commit()
        return True
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
