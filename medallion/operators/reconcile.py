"""Name reconciliation between two sources.

R3 normalises the names on both sides and de-duplicates them (map-side partial
aggregation, so a name carried by a third of all rows is collapsed before any
shuffle).  The two distinct lists are tagged with their side and unioned; a
window over the normalised name then keeps the names whose group has one side
only.  Each source is read once, and a window group holds the distinct
spellings of one name, not its rows.  R4 replaces the reference's interactive prompt
with an override table joined in by exact name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.keys import name_norm
from medallion.functions.text import smallest_target, strip, strip_conglomerate


def normalised_names(df: DataFrame, column: str) -> DataFrame:
    """Distinct (name, name_norm) of one source; blank names are left out."""
    name = strip(strip_conglomerate(F.col(column)))
    return (
        df.select(name.alias("name"))
        .where(F.col("name").isNotNull() & (F.col("name") != ""))
        .withColumn("name_norm", name_norm(F.col("name")))
        .distinct()
    )


def reconciliation(left: DataFrame, left_col: str, right: DataFrame, right_col: str,
                   left_label: str = "left", right_label: str = "right") -> DataFrame:
    """Names present on one side only, labelled by side."""
    if left_label == right_label:
        raise ValueError("the two sides need different labels")
    tagged = (
        normalised_names(left, left_col).select(F.lit(left_label).alias("side"), "name", "name_norm")
        .unionByName(normalised_names(right, right_col).select(F.lit(right_label).alias("side"), "name", "name_norm"))
    )
    w = Window.partitionBy("name_norm")
    one_side = F.min("side").over(w) == F.max("side").over(w)
    return tagged.withColumn("__one_side", one_side).where("__one_side").drop("__one_side")


def reconciliation_summary(report: DataFrame) -> DataFrame:
    """Counts of unmatched names per side (the reference prints ``len`` of each list)."""
    return report.groupBy("side").agg(F.count(F.lit(1)).alias("unmatched"))


def conflicting(overrides: DataFrame, from_col: str = "from_name", to_col: str = "to_name") -> DataFrame:
    """Names that an override or alias table sends to more than one target, with the targets' number."""
    return (overrides.where(F.col(from_col).isNotNull() & F.col(to_col).isNotNull()).groupBy(from_col)
            .agg(F.count_distinct(to_col).alias("targets"), F.min(to_col).alias("taken")).where("targets > 1"))


def apply_overrides(df: DataFrame, column: str, overrides: DataFrame,
                    from_col: str = "from_name", to_col: str = "to_name") -> DataFrame:
    """Replace names listed in ``overrides``; others keep their value.

    Of several targets of one name the smallest is taken (``conflicting`` lists such names); a null
    name or target overrides nothing.
    """
    o = smallest_target(overrides, from_col, to_col)
    out = df.join(o, df[column] == o["__from"], "left")
    return out.withColumn(column, F.coalesce(F.col("__to"), F.col(column))).drop("__from", "__to")
