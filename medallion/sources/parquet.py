"""Parquet sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def layer_path(root: str, layer: str, table: str) -> str:
    """Layout ``<root>/<layer>/<table>/`` for the raw / trusted / delivery layers."""
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A parquet dataset (folder) written by a previous layer."""
    return spark.read.parquet(layer_path(root, layer, table))


def sql_scan(spark: SparkSession, path: str) -> DataFrame:
    """Scan a parquet folder from SQL, ``SELECT * FROM parquet.`path```."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def register_scan(spark: SparkSession, view: str, path: str) -> DataFrame:
    """The reference's ``CREATE TABLE x AS SELECT * FROM read_parquet(...)``.

    A temporary view over the parquet files: nothing is copied, and every query
    on the view gets column pruning and filter pushdown into the scan.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{view}` USING parquet OPTIONS (path '{path}')")
    return spark.table(view)
