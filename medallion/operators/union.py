"""Set operators (U1, U2): union by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(left: DataFrame, right: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Columns matched by name; a column missing on one side is null there."""
    return left.unionByName(right, allowMissingColumns=allow_missing)


def union_all_by_name(dfs: Iterable[DataFrame]) -> DataFrame:
    """The union of many inputs (``pd.concat`` semantics, no de-duplication)."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(union_by_name, dfs)
