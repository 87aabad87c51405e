"""Strip accents from text.

The default path is native: one ``translate`` over every Latin letter that has
a canonical decomposition into an ASCII letter plus combining marks, followed by
a handful of literal replacements for letters that do not decompose (``ß``,
``æ``, ``ø``...).  The translate table is generated from a rule (Unicode
canonical decomposition), not written out by hand.  It stays inside whole-stage
codegen -- no Python worker is involved.  Greek and Cyrillic letters are written in
Latin ones first (``functions.scripts``).

``unaccent_nfkd`` is the optional full-Unicode path: an Arrow-batched pandas
UDF applying NFKD and dropping combining marks.  It is the slow path and is
never used by the library's own plans.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from medallion.functions.scripts import letters, marked, to_latin
from medallion.functions.scripts import FIRST as FIRST_LETTER
from medallion.functions.text import UNICODE_SPACES

ColumnOrName = Column | str

# Blocks scanned for decomposable letters: Latin-1 Supplement, Latin
# Extended-A and -B, and Latin Extended Additional.
_LATIN_RANGE = (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00))

# Combining marks (and characters of no width), deleted: text in decomposed form
# gives what its precomposed form gives.
_DELETED = "".join(map(chr, (*range(0x0300, 0x0370), 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))

# Punctuation by its ASCII form.
PUNCTUATION: dict[str, str] = {
    **dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2015\u2212", "-"),
    **dict.fromkeys("\u2018\u2019\u201a\u201b\u2032", "'"),
    **dict.fromkeys("\u201c\u201d\u201e\u201f\u2033", '"'),
}

# Letters without a canonical decomposition, transliterated the
# way common ASCII-folding tables do it.  One-letter results join the translate
# table; the others are literal replacements.
LIGATURES: dict[str, str] = {
    "ß": "ss", "ẞ": "SS",
    "æ": "ae", "Æ": "AE",
    "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O",
    "ł": "l", "Ł": "L",
    "đ": "d", "Đ": "D",
    "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "Th",
    "ħ": "h", "Ħ": "H",
    "ı": "i",
    "ŧ": "t", "Ŧ": "T",
    "ŀ": "l", "Ŀ": "L",
}

MULTI_LETTER = {k: v for k, v in LIGATURES.items() if len(v) > 1}


@lru_cache(maxsize=1)
def translate_table() -> tuple[str, str]:
    """(source letters, ASCII letters) for ``F.translate``, built by rule.

    The source ends with the characters that are deleted: they have no counterpart.
    """
    src, dst = [], []
    for k, v in (*LIGATURES.items(), *PUNCTUATION.items(), *dict.fromkeys(UNICODE_SPACES, " ").items()):
        if len(v) == 1:
            src.append(k)
            dst.append(v)
    for cp in _LATIN_RANGE:
        ch = chr(cp)
        if ch in LIGATURES:
            continue
        decomposed = unicodedata.normalize("NFD", ch)
        base, marks = decomposed[0], decomposed[1:]
        if len(decomposed) > 1 and base.isascii() and base.isalpha() and all(unicodedata.combining(m) for m in marks):
            src.append(ch)
            dst.append(base)
    return "".join(src) + _DELETED, "".join(dst)


def unaccent(c: ColumnOrName) -> Column:
    """Native accent stripping and transliteration."""
    src, dst = translate_table()
    out = F.translate(to_latin(c), src, dst)
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), MULTI_LETTER.items(), out)


def _nfkd_strip(text: str | None) -> str | None:
    if text is None:
        return None
    for apart, together in marked().items():
        text = text.replace(apart, together)
    text = text.translate(_spelled())
    folded = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
    return folded.translate(_folding())


@lru_cache(maxsize=1)
def _spelled() -> dict:
    """Greek and Cyrillic letters as Python's table."""
    return {FIRST_LETTER + i: x for i, x in enumerate(letters()) if x is not None}


@lru_cache(maxsize=1)
def _folding() -> dict:
    """The native table as Python's, with the letters that become several."""
    src, dst = translate_table()
    return {**dict(zip(map(ord, src), dst)), **dict.fromkeys(map(ord, _DELETED)), **{ord(k): v for k, v in MULTI_LETTER.items()}}


@pandas_udf(T.StringType())
def unaccent_nfkd(s: pd.Series) -> pd.Series:
    """Full-Unicode NFKD accent stripping, Arrow-batched (slow path)."""
    return s.map(_nfkd_strip)
