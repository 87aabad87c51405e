"""Relational table scan over JDBC, partitioned.

The reference reads a published table back through one JDBC connection (one
partition).  Here the read is split on a numeric column into ``num_partitions``
range queries that run on the executors in parallel; with no partition column
it degrades to the single-connection read.  Equal widths of a skewed column are
unequal numbers of rows: ``balanced_predicates`` splits at boundaries of equal depth instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.session import scratch_path


def jdbc_read_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    return opts


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError("boundaries are numbers, texts or dates")
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def balanced_predicates(column: str, boundaries: Sequence) -> list[str]:
    """Conditions that cover every row once: below, between and above the boundaries, and nulls.

    With equal numbers of rows between the boundaries (``equi_depth_boundaries``) every
    connection reads its share, however skewed the values are.
    """
    bounds = sorted(set(boundaries))
    name = '"' + column.replace('"', '""') + '"'
    if not bounds:
        return ["1 = 1"]
    parts = [f"{name} < {_literal(bounds[0])} OR {name} IS NULL"]
    parts += [f"{name} >= {_literal(a)} AND {name} < {_literal(b)}" for a, b in zip(bounds, bounds[1:])]
    return [*parts, f"{name} >= {_literal(bounds[-1])}"]


def equi_depth_boundaries(sample: DataFrame, column: str, parts: int) -> list:
    """``parts`` - 1 boundaries with about as many rows of the sample in between (fewer if one value has more than a share).

    ``sample`` is a published copy of the table or a part of it that stands for it, read as
    a DataFrame; only the boundaries come to the driver.  Values of any type that has an order will do.
    """
    return [value for _, value in equi_depth_shares(sample, column, parts)]


def equi_depth_shares(sample: DataFrame, column: str, parts: int) -> list[tuple[int, object]]:
    """(share, smallest value) of the shares 1 to ``parts`` - 1 in which a value begins, in order."""
    counts = sample.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    path = scratch_path(sample.sparkSession, "boundaries")  # written: made again, the ranges might be cut elsewhere
    counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ordered = sample.sparkSession.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ordered.groupBy("part").agg(F.sum("n").alias("in_part")).withColumn("base", F.coalesce(F.sum("in_part").over(before), F.lit(0)))
    total = bases.agg(F.sum("in_part")).first()[0] or 0
    within = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.join(F.broadcast(bases.drop("in_part")), "part").withColumn("rank", F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    # the first value of each share
    share = F.floor(F.col("rank") * parts / F.lit(max(total, 1)))
    rows = placed.groupBy(share.alias("share")).agg(F.min("value").alias("value")).where("share > 0").collect()
    return sorted((r["share"], r["value"]) for r in rows)


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, boundaries: Sequence, properties: Mapping[str, str] | None = None) -> DataFrame:
    """A table read over one connection for each of the shares."""
    return spark.read.jdbc(url, table, predicates=balanced_predicates(column, boundaries), properties=dict(properties or {}))


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Read a table; keyword arguments as in :func:`jdbc_read_options`."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **kwargs)).load()
