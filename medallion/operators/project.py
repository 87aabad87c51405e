"""Projection operators (P1, P2, P6, P7; the others are DataFrame methods used as they are).

All of these are plain DataFrame projections; Catalyst collapses consecutive
ones and prunes unused columns down to the scan.  Column lists derived from
schemas keep the DataFrame's own column order -- never a Python ``set`` order,
which changes between runs (TR8).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """A column reference that tolerates spaces, dashes and dots in the name."""
    return F.col(f"`{name}`")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bulk rename; names not in ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def column_difference(left: DataFrame, right: DataFrame | Sequence[str], keep: Sequence[str] = ()) -> list[str]:
    """Columns of ``left`` that ``right`` (a table, or its columns) does not have, plus ``keep``, in ``left`` order."""
    right_cols = set(right.columns if isinstance(right, DataFrame) else right)
    out = [c for c in left.columns if c not in right_cols]
    out += [k for k in keep if k not in out]
    return out


def keep_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop every column not listed (as one projection)."""
    return df.select(*[q(c) for c in columns])
