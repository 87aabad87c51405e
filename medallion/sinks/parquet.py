"""Parquet sinks (K1-K5): one folder per layer and table.

Writes are distributed: every task writes its own part files, capped by
``max_records_per_file`` so no file outgrows what one reader task should take.
A table can be partitioned on low-cardinality columns (claims by year and
quarter) so later reads prune partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import TableContract
from medallion.sinks.jdbc import contract_column_types
from medallion.sources.parquet import layer_path

SAVE_MODES = ("overwrite", "append", "errorifexists", "ignore")


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    max_records_per_file: int = 5_000_000,
) -> str:
    """K1-K4: snappy parquet with an explicit save mode."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    if partition_by:
        # one file for each small period, several for a big one: without this every
        # task writes a file for each period it has rows of
        df = df.hint("rebalance", *partition_by)
    writer = (
        df.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def replace_periods(df: DataFrame, path: str, partition_by: Sequence[str], periods: Sequence[tuple] | None = None,
                    max_records_per_file: int = 5_000_000) -> str:
    """K2 for a part of a table: the periods that ``df`` has rows of are replaced, all others keep their files.

    ``periods`` (values in the order of ``partition_by``) lists what the caller means to replace: a
    listed period without rows is emptied, and rows of a period that is not listed are an error.  Running it again gives
    the same table.
    """
    spark, old = df.sparkSession, {}
    if periods is not None:  # an error in a task: the write is not committed and nothing is replaced
        stray = F.raise_error(F.concat_ws(" ", F.lit("rows of a period that is not to be replaced:"), *(F.col(c).cast("string") for c in partition_by)))
        df = df.where(F.when(in_periods(partition_by, periods), F.lit(True)).otherwise(stray.cast("boolean")))
        old = {p: _file_names(spark, _period_folder(spark, path, partition_by, p)) for p in periods}
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(*partition_by).parquet(path))
    for period, names in old.items():  # files of before are still there: the new version has no rows of this period
        folder = _period_folder(spark, path, partition_by, period)
        if names & _file_names(spark, folder):
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return path


def _period_folder(spark: SparkSession, path: str, partition_by: Sequence[str], period: tuple):
    parts = (f"{c}={_partition_value(spark, v)}" for c, v in zip(partition_by, period))
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))


def _file_names(spark: SparkSession, folder) -> set[str]:
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()


def _partition_value(spark: SparkSession, value: object) -> str:
    """A value as Spark writes it into a folder name."""
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return catalog.DEFAULT_PARTITION_NAME() if value in (None, "") else catalog.escapePathName(str(value))


def in_periods(partition_by: Sequence[str], periods: Sequence[tuple]) -> Column:
    """A filter for the periods listed that prunes partitions; a null value is a period too."""
    found = F.lit(False)
    for first in sorted({p[0] for p in periods}, key=lambda v: (v is not None, str(v))):
        rest = [p[1:] for p in periods if p[0] == first]
        here = F.col(partition_by[0]).isNull() if first is None else F.col(partition_by[0]) == F.lit(first)
        found = found | (here & in_periods(partition_by[1:], rest) if len(partition_by) > 1 else here)
    return found


def write_layer(df: DataFrame, root: str, layer: str, table: str, mode: str = "overwrite", **kwargs) -> str:
    """Write ``<root>/<layer>/<table>/``; overwrite by default so a re-run gives the same table."""
    return write_parquet(df, layer_path(root, layer, table), mode=mode, **kwargs)


def sql_copy_parquet(spark: SparkSession, view: str, path: str) -> None:
    """K5: the reference's ``COPY t TO 'p' (FORMAT PARQUET)`` as Spark SQL."""
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING parquet SELECT * FROM `{view}`")


def create_table_ddl(table: str, columns: Sequence[tuple[str, str]], location: str,
                     partition_by: Sequence[str] = ()) -> str:
    """K9: ``CREATE TABLE IF NOT EXISTS`` with declared column types, stored as parquet."""
    cols = ", ".join(f"`{name}` {sql_type}" for name, sql_type in columns)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{parts} LOCATION '{location}'"


def publish_table(spark: SparkSession, df: DataFrame, table: str, location: str, contract: TableContract,
                  overwrite: bool = True) -> DataFrame:
    """K9 + K2: create the catalog table if absent, with the contract's types and lengths, then fill it.

    Numbers keep their own type here (declared decimals are for relational targets).
    ``insertInto`` matches columns by position, so ``df`` is selected in the
    table's column order first.
    """
    types = contract_column_types(contract, decimals=False)
    spark.sql(create_table_ddl(table, list(types.items()), location))
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=overwrite)
    return spark.table(table)
