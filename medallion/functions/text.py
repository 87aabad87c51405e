"""Text cleaners: ``Column -> Column`` expressions, no actions, no Python rows.

Every function here compiles to built-in Catalyst expressions, so a whole
table's cleaning collapses into one projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's for matching results: the
# markers the reference strips from institution names, and the ordinal sign it
# drops from quarter text.
CONGLOMERATE_MARKER = " (conglomerado)"
PRUDENTIAL_MARKER_PATTERN = r" \(?- PRUDENCIAL\)?"
ORDINAL_SIGN = "º"
ID_WIDTH = 8


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of Java's ``\\s`` class: space, tab, newline, vertical tab,
# form feed, carriage return.
WHITESPACE = " \t\n\x0b\f\r"
# Unicode's other blanks (White_Space beyond ASCII).
UNICODE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def without_blanks(c: ColumnOrName) -> Column:
    """Every blank of any kind removed, in one pass."""
    return F.translate(_col(c), WHITESPACE + UNICODE_SPACES, "")


def blank_to_null(c: ColumnOrName) -> Column:
    """Empty or all-blank text (blanks of any kind) becomes null; other values are kept as they are."""
    c = _col(c)
    return F.when(without_blanks(c) != F.lit(""), c)


def pad_id(c: ColumnOrName, width: int = ID_WIDTH) -> Column:
    """Blanks removed, then left zero-pad to ``width`` without ever truncating a longer id.

    Blank ids become null first (D1), so a null id never joins.
    """
    bare = F.nullif(without_blanks(c), F.lit(""))
    return F.lpad(bare, F.greatest(F.length(bare), F.lit(width)), F.lit("0"))


def pad_truncate(c: ColumnOrName, width: int = ID_WIDTH) -> Column:
    """Plain ``lpad``; cuts ids longer than ``width`` (kept for parity, T1 is the default)."""
    return F.lpad(_col(c), width, "0")


def lower(c: ColumnOrName) -> Column:
    """T3."""
    return F.lower(_col(c))


def strip(c: ColumnOrName) -> Column:
    """T4: strip leading and trailing whitespace of any kind (``trim`` alone only drops U+0020)."""
    return F.trim(_col(c), F.lit(WHITESPACE + UNICODE_SPACES))


def remove_spaces(c: ColumnOrName) -> Column:
    """T5: remove every U+0020."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def remove_whitespace(c: ColumnOrName) -> Column:
    """Remove every whitespace character (``regexp_replace(c, '\\s+', '')``).

    ``translate`` deletes characters that have no replacement, which does the
    same as the regex in one pass without a regex engine.
    """
    return F.translate(_col(c), WHITESPACE, "")


def regex_replace_all(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace every match (the mode the layers use)."""
    return F.regexp_replace(_col(c), pattern, replacement)


def regex_replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace the first match only (the default of some SQL engines).

    Built from ``regexp_instr`` (start of the first match) and
    ``regexp_extract`` (its text); ``replacement`` is literal text.
    """
    c = _col(c)
    start = F.regexp_instr(c, F.lit(pattern))
    match = F.regexp_extract(c, pattern, 0)
    before = c.substr(F.lit(1), start - 1)
    after = c.substr(start + F.length(match), F.length(c))
    return F.when(start > 0, F.concat(before, F.lit(replacement), after)).otherwise(c)


def literal_replace(c: ColumnOrName, search: str, replacement: str = "") -> Column:
    """Literal substring replacement, no regex."""
    return F.replace(_col(c), F.lit(search), F.lit(replacement))


def strip_conglomerate(c: ColumnOrName) -> Column:
    """Drop the ``(conglomerado)`` suffix marker."""
    return literal_replace(c, CONGLOMERATE_MARKER, "")


def strip_prudential(c: ColumnOrName) -> Column:
    """Drop the ``- PRUDENCIAL`` marker, with or without parentheses."""
    return F.regexp_replace(_col(c), PRUDENTIAL_MARKER_PATTERN, "")


def drop_ordinal(c: ColumnOrName) -> Column:
    """``'4º'`` -> ``'4'``."""
    return literal_replace(c, ORDINAL_SIGN, "")


def cut_decimals(c: ColumnOrName) -> Column:
    """``'2000.0'`` -> ``'2000'``; everything from the first dot goes."""
    return F.substring_index(_col(c), ".", 1)


def concat_text(*cols: ColumnOrName) -> Column:
    """Null-propagating concatenation (a null part gives a null key, D3)."""
    return F.concat(*[_col(c) for c in cols])


def split_part_trim(c: ColumnOrName, delimiter: str, part: int) -> Column:
    """1-based part of ``c`` split on a literal delimiter, trimmed.

    Negative ``part`` counts from the end.  A missing part gives ``''``.
    """
    return F.trim(F.split_part(_col(c), F.lit(delimiter), F.lit(part)))


def locale_decimal_text(c: ColumnOrName) -> Column:
    """T20, text step: ``'1.234.567,89'`` -> ``'1234567.89'`` (thousand dots, comma, blanks)."""
    c = _col(c)
    return F.replace(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))


def locale_decimal(c: ColumnOrName) -> Column:
    """Pt-BR number text (``'1.234.567,89'``) -> double; junk -> null."""
    from medallion.functions.casts import to_double

    return to_double(locale_decimal_text(c))


def alias_map(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Whole-value mapping; values not in the map pass through.

    The map is a literal in the plan, so it must stay small (tens of entries);
    for a mapping table that grows with the data use ``map_by_join``.
    """
    return alias_of(c, c, mapping)


def alias_of(key: ColumnOrName, c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """T17 looked up by another form of the value (e.g. without the blanks around it)."""
    if not mapping:
        return _col(c)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[_col(key)], _col(c))


def alias_substring(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Successive literal replacements in map order (the pandas behaviour).

    A key occurring inside a longer name is also replaced; ``alias_map`` is the
    default for that reason.
    """
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), mapping.items(), _col(c))


def smallest_target(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """(__from, __to): one target for each value, the smallest, whatever the order of the rows."""
    pairs = mapping.select(F.col(key).alias("__from"), F.col(value).alias("__to"))
    return pairs.where("__from IS NOT NULL AND __to IS NOT NULL").groupBy("__from").agg(F.min("__to").alias("__to"))


def map_by_join(df: DataFrame, column: str, mapping: DataFrame, key: str = "from_value", value: str = "to_value") -> DataFrame:
    """T17 at scale: whole-value mapping through a left join with a mapping table.

    The planner broadcasts ``mapping`` only when its size is under the session
    threshold; beyond it the join is a sort-merge join.  Of several targets of one value
    the smallest is taken.
    """
    m = smallest_target(mapping, key, value)
    joined = df.join(m, df[column] == m["__from"], "left")
    return joined.withColumn(column, F.coalesce(F.col("__to"), F.col(column))).drop("__from", "__to")
