"""Casts that never throw.

Spark 4 runs with ANSI mode on, so ``cast('' as int)`` raises where the
reference's Spark 3 jobs got a null.  Every text-to-number conversion here uses
``try_cast``; text that does not parse becomes null and is counted by the
cast-failure audit (R7) instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Shapes of number text.  ``try_cast`` returns null for bad text, but it gets
# there by raising and catching an exception per row, which costs tens of
# microseconds; dirty columns (a quarter of the rows blank) spend most of their
# time there.  Only text of the right shape is handed to the cast.
# Blanks around it are for the cast to drop.
INTEGER_TEXT = r"^ *[+-]?[0-9]+ *$"
DECIMAL_TEXT = r"^ *(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|NaN|[+-]?Infinity) *$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guarded(c: ColumnOrName, shape: str, type_name: str) -> Column:
    c = _col(c)
    return F.when(c.rlike(shape), c.try_cast(type_name))


def to_long(c: ColumnOrName) -> Column:
    """Text -> bigint; ``'12'`` -> 12, ``' '``/``'x'`` -> null."""
    return _guarded(c, INTEGER_TEXT, "bigint")


def to_int(c: ColumnOrName) -> Column:
    return _guarded(c, INTEGER_TEXT, "int")


def to_double(c: ColumnOrName) -> Column:
    return _guarded(c, DECIMAL_TEXT, "double")


#: A whole number, perhaps with decimals; what comes before the point is its value.
PLAIN_TEXT = r"^ *[+-]?[0-9]+(?:\.[0-9]*)? *$"
# Room for every digit of a bigint, and 18 decimals.
_EXACT = "decimal(38,18)"


def _float_text(c: ColumnOrName, type_name: str) -> Column:
    """Plain numbers are cut at the point; exponents and the like go through an exact decimal."""
    c = _col(c)
    return (F.when(c.rlike(PLAIN_TEXT), F.substring_index(c, ".", 1).try_cast(type_name))
            .otherwise(_guarded(c, DECIMAL_TEXT, _EXACT).try_cast(type_name)))


def float_text_to_long(c: ColumnOrName) -> Column:
    """``'2000.0'`` -> 2000, no digit through a double; out-of-range or junk -> null."""
    return _float_text(c, "bigint")


def float_text_to_int(c: ColumnOrName) -> Column:
    """C3 for int: everything that truncates to a value in its range."""
    return _float_text(c, "int")


_CASTERS = {
    "bigint": to_long,
    "long": to_long,
    "int": to_int,
    "integer": to_int,
    "double": to_double,
    "string": lambda c: _col(c),
}


def try_cast_to(c: ColumnOrName, type_name: str) -> Column:
    caster = _CASTERS.get(type_name)
    if caster is None:
        return _col(c).try_cast(type_name)
    return caster(c)


def cast_map(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast many columns at once, in one projection, keeping column order."""
    return df.select(*[
        try_cast_to(name, types[name]).alias(name) if name in types else F.col(f"`{name}`")
        for name in df.columns
    ])
