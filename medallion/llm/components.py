"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours, then its smaller ones, to the
smallest node next to it; the edges end as stars around each component's smallest
node.  Edges stay a table throughout (a round's edges are checkpointed in the shared
folder); the driver only sees their number and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.session import checkpoint_root


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node that has an edge in ``edges(a, b)``; root is the smallest node it reaches."""
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        # large star: the neighbours above a node go to the smallest next to it
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(low, both["a"] == low["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: a node and the neighbours below it go to the smallest of those
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        joined = large.join(low, large["a"] == low["n"])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
        edges = small.where("a <> b").distinct().checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
