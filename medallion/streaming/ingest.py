"""Incremental raw ingestion of a landing folder (the raw layer's append, K3).

The reference re-reads whole folders of quarterly files on every run and
either overwrites or appends them.  With Structured Streaming the file source
remembers which files it has already taken (in the checkpoint), so each run
appends only files that arrived since the last one, and a restarted run after a
lost executor resumes from the checkpoint.  Trigger ``availableNow`` processes the
backlog in bounded micro-batches and stops, so the same job runs as a scheduled
batch.

The stream itself only lists the new files (no content is read for that).  Each
micro-batch reads its files by header name, like a folder: files may order their
columns differently.  A header with a column that the contract does not know
fails the batch, by name, before a row is written.  A micro-batch is one folder of
the target (``ingest_batch=N``) and replaces what an interrupted attempt left there,
so every file is in the target exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from medallion.contracts import TableContract
from medallion.sources.delimited import MALFORMED, conform, read_files

BATCH_COLUMN = "ingest_batch"
# Fixed value: the schema of Spark's binary-file source; the content is never selected.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def check_columns(df: DataFrame, contract: TableContract) -> DataFrame:
    """``df``, unless it has columns that the contract does not know."""
    unknown = sorted(set(df.columns) - set(contract.raw_names) - {"source_file", MALFORMED})
    if unknown:
        raise ValueError(f"columns that the contract {contract.name!r} does not know: {unknown}")
    return df


def ingest_landing(
    spark: SparkSession,
    landing: str,
    contract: TableContract,
    target: str,
    checkpoint: str,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
) -> StreamingQuery:
    """Append every new file of ``landing`` to the raw parquet table ``target``.

    Rows keep the name of the file they came from.  ``max_files_per_trigger``
    bounds a micro-batch (its list of files is held by the driver); all files
    are taken, in as many micro-batches as needed.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path", "length"))

    def append(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.where("length > 0").select("path").collect()]
        if paths:
            rows = check_columns(read_files(spark, paths, contract.sep, contract.encoding), contract)
            conform(rows, contract).write.mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH_COLUMN}={number}")

    writer = files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_once(spark: SparkSession, *args, **kwargs) -> None:
    """Run one ``availableNow`` ingestion to completion."""
    q = ingest_landing(spark, *args, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
