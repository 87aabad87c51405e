"""De-duplication.

``first_by`` is the deterministic "keep one row per key" operator.  It is the
reference's ``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ...) = 1`` with a
declared tie-break; Catalyst turns the ``row_number() = 1`` filter into a
``WindowGroupLimit`` that already keeps one row per key *before* the shuffle
(partial stage), so a key holding a third of the table is reduced map-side
instead of being sorted whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (hash aggregate with map-side partial merge)."""
    return df.distinct()


def dedup_subset(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key (``dropDuplicates``); see ``first_by`` for a fixed survivor."""
    return df.dropDuplicates(list(keys))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group under ``order``.

    ``order`` must be a total order within a group for the survivor to be
    deterministic (append unique columns as final tie-breaks).
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)
