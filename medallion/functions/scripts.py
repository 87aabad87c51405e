"""T14 / X1 beyond Latin: Greek and Cyrillic letters in Latin ones, native.

What a letter becomes follows from its Unicode name: a consonant is called by its sound and a
vowel (``BE``, ``SHCHA``, ``THETA``), or a vowel and its sound (``EL``); a vowel's name begins with it.
The few letters whose names say something else are listed.  Letters with marks have the
result of their base letter unless they have a name of their own (``SHORT I``, ``IO``).

Only text with such letters is looked at letter by letter, each by one array access; all other text costs
one pattern test.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modern letters: Greek, Cyrillic and the Ukrainian letter ghe with upturn.
_MODERN = (*range(0x0386, 0x03CF), *range(0x0400, 0x0460), 0x0490, 0x0491)
FIRST, LAST = _MODERN[0], _MODERN[-1]

# Letters that are not written as their names begin.
EXCEPTIONS = {
    "GHE": "g", "GHE WITH UPTURN": "g", "IE": "e", "IO": "yo", "SHORT I": "y", "YERU": "y", "HARD SIGN": "", "SOFT SIGN": "", "HA": "kh",
    "UKRAINIAN IE": "ye", "YI": "yi", "BYELORUSSIAN-UKRAINIAN I": "i", "SHORT U": "u", "YU": "yu", "YA": "ya", "RHO": "r",
}
_NAME = re.compile(r"(GREEK|CYRILLIC) (CAPITAL|SMALL) LETTER (?:FINAL )?(.+)")


def latin_of(char: str) -> str | None:
    """The Latin letters of a Greek or Cyrillic one; None for any other character."""
    found = _NAME.fullmatch(unicodedata.name(char, ""))
    if not found:
        return None
    name, base = found[3], unicodedata.normalize("NFD", char)[0]
    if name in EXCEPTIONS:
        out = EXCEPTIONS[name]
    elif base != char:
        return latin_of(base)
    elif m := re.fullmatch(r"([^AEIOUY ]+)[AEIOU][A-Z]*|[AEIOU]([^AEIOU ])", name):
        out = (m[1] or m[2]).lower()
    elif re.fullmatch(r"[AEIOU][A-Z]*", name):
        out = name[0].lower()
    else:
        return None
    return out.capitalize() if found[2] == "CAPITAL" else out


@lru_cache(maxsize=1)
def letters() -> tuple[str | None, ...]:
    """What each character from ``FIRST`` to ``LAST`` becomes."""
    return tuple(latin_of(chr(c)) if c in _MODERN else None for c in range(FIRST, LAST + 1))


@lru_cache(maxsize=1)
def marked() -> dict[str, str]:
    """Base letter and mark of the letters that have a name of their own with it."""
    out = {}
    for c in _MODERN:
        apart = unicodedata.normalize("NFD", chr(c))
        if len(apart) == 2 and latin_of(chr(c)) not in (None, latin_of(apart[0])):
            out[apart] = chr(c)
    return out


def to_latin(c: Column | str) -> Column:
    """Greek and Cyrillic letters in Latin ones; everything else as it is."""
    c = F.col(c) if isinstance(c, str) else c
    table = F.array(*map(F.lit, letters()))
    whole = c
    for apart, together in marked().items():
        whole = F.replace(whole, F.lit(apart), F.lit(together))
    spelled = F.transform(F.split(whole, ""), lambda ch: F.coalesce(F.get(table, F.ascii(ch) - FIRST), ch))
    return F.when(c.rlike(f"[{chr(FIRST)}-{chr(LAST)}]"), F.array_join(spelled, "")).otherwise(c)


def to_latin_sql(arg: str, quote) -> str:
    """The same as SQL; ``quote`` makes a string literal."""
    whole = arg
    for apart, together in marked().items():
        whole = f"replace({whole}, {quote(apart)}, {quote(together)})"
    table = ", ".join("NULL" if x is None else quote(x) for x in letters())
    spelled = f"array_join(transform(split({whole}, ''), ch -> coalesce(get(array({table}), ascii(ch) - {FIRST}), ch)), '')"
    return f"CASE WHEN {arg} RLIKE {quote(f'[{chr(FIRST)}-{chr(LAST)}]')} THEN {spelled} ELSE {arg} END"
