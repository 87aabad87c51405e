"""Stored tables that join without moving their rows.

The trusted claims are joined on their id again and again.  Stored in buckets of the id they
need no exchange, neither for the join nor for the distinct before it.  A plain bucket of an
id that holds a third of all claims would be a third of the table, and without an exchange adaptive
execution has nothing to split.  So the bucket is of the id and a *part*:

* ids with more than their share (one bucket's rows) are hot; there can be at most as many of them as
  buckets.  A hot id's rows are dealt over parts by a hash of the row;
* the other side, which is bounded by institutions and profiles, has its rows of a hot id once for each part;
* all others have part 0 on both sides.

Equal rows have equal parts, so a distinct still finds them in one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.sources.parquet import layer_path

BUCKETS = 64
#: Parts of a hot key for each share of rows it has: several small ones fill the buckets evenly.
PARTS = 4
PART = "bucket_part"


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, parts) of the keys with more rows than a bucket's share: fewer than ``buckets`` rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    total = df.count()
    share = max(total // buckets, 1)
    return counts.where(F.col("rows") > share).select(key, F.least(F.ceil(F.col("rows") * PARTS / F.lit(share)), F.lit(buckets)).cast("int").alias("parts"))


def with_part(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The large side: a row of a hot key has one of its parts."""
    row = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.col("parts")).cast("int")
    dealt = df.join(F.broadcast(hot), key, "left")  # fewer rows than buckets
    return dealt.withColumn(PART, F.coalesce(row, F.lit(0))).drop("parts").select(*df.columns, PART)


def for_each_part(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The small side: a row of a hot key once for each part."""
    dealt = df.join(F.broadcast(hot), key, "left").withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
    return dealt.drop("parts").select(*df.columns, PART)


def write_bucketed(df: DataFrame, table: str, location: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Store a table in buckets of the keys, one sorted file for each, and read it back with them."""
    spark = df.sparkSession
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", location)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def write_joinable(spark: SparkSession, root: str, name: str, large: DataFrame, small: DataFrame, key: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Both sides stored in the same buckets; tables ``<name>_large`` and ``<name>_small``."""
    hot = hot_keys(large, key, buckets)
    sides = (with_part(large.where(F.col(key).isNotNull()), key, hot), for_each_part(small.where(F.col(key).isNotNull()), key, hot))
    return tuple(write_bucketed(side, f"{name}_{kind}", layer_path(root, "bucketed", f"{name}_{kind}"), [key, PART], buckets)
                 for kind, side in zip(("large", "small"), sides))


def join_stored(large: DataFrame, small: DataFrame, key: str, columns: Sequence[str | Column], distinct: bool = False) -> DataFrame:
    """The join of two sides stored by ``write_joinable``; with ``distinct``, of the large side's distinct rows."""
    left = large.distinct() if distinct else large
    return left.join(small.hint("merge"), [key, PART], "inner").select(*columns)
