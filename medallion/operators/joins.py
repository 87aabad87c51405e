"""Joins (J1-J6).

No join here forces a broadcast.  The planner broadcasts a side when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-decides with the measured size of the shuffled side
(``spark.sql.adaptive.autoBroadcastJoinThreshold``); beyond that the join is a
sort-merge join whose skewed partitions AQE splits.  That is the size check
behind every broadcast, and the fallback beyond it.  Inner equi-joins get an
inferred ``isnotnull(key)`` filter (a join on a computed key filters the column it
is made of), so rows without a key never reach the shuffle and cannot pile up in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named keys; each key appears once in the output."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right, on=keys, how=how)


def join_on_key(left: DataFrame, right: DataFrame, key: str, source: str | None = None) -> DataFrame:
    """Inner join on a computed text key that is null for rows without one; the key appears once.

    An inner join gets a not-null filter on its keys, and that filter would compute the key a
    second time below the projection.  The left side joins on a form of the key that is never null
    (the empty text, which no key is), so the key is computed once for each of its rows.

    ``source`` is the column that the left key is made of: rows without it have no key and are filtered by
    that column, so that they are not all sent to one partition as rows of one key.
    """
    r = right.where(F.col(key).isNotNull()).withColumnRenamed(key, "__key")
    if source:
        left = left.where(F.col(source).isNotNull())
    return left.join(r, F.coalesce(left[key], F.lit("")) == r["__key"]).drop("__key")


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
              null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    ``null_safe`` treats null as a value (pandas ``isin`` semantics): a null
    key on the left is excluded when the right side has a null key too.
    """
    right_key = right_key or left_key
    r = right.select(F.col(right_key).alias("__anti_key")).distinct()
    cond = left[left_key].eqNullSafe(r["__anti_key"]) if null_safe else left[left_key] == r["__anti_key"]
    return left.join(r, on=cond, how="left_anti")


def anti_both_ways(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """(left rows missing from right, right rows missing from left)."""
    return (
        anti_join(left, right, left_key, right_key, null_safe),
        anti_join(right, left, right_key, left_key, null_safe),
    )
