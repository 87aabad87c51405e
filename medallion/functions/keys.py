"""Hash and surrogate-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medallion.functions.text import remove_whitespace
from medallion.functions.unaccent import unaccent

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha1_hex(c: ColumnOrName) -> Column:
    """H1: 40-hex SHA-1 of the UTF-8 text."""
    return F.sha1(_col(c))


def md5_hex(c: ColumnOrName) -> Column:
    """H2: 32-hex MD5 of the UTF-8 text."""
    return F.md5(_col(c))


def hash_hex(c: ColumnOrName, algo: str = "sha1") -> Column:
    if algo == "sha1":
        return sha1_hex(c)
    if algo == "md5":
        return md5_hex(c)
    raise ValueError(f"unknown hash algorithm {algo!r}")


def name_norm(c: ColumnOrName) -> Column:
    """The comparable form of a name: unaccented, lower-case, no whitespace."""
    return remove_whitespace(F.lower(unaccent(c)))


def name_key(c: ColumnOrName, algo: str = "sha1") -> Column:
    """Surrogate key of an institution name; null name -> null key."""
    return hash_hex(name_norm(c), algo)


def document_key(id_col: ColumnOrName, segment_col: ColumnOrName, algo: str = "sha1") -> Column:
    """Y2: key of (8-digit id, segment); a null part gives a null key (D3)."""
    return hash_hex(F.concat(_col(id_col), _col(segment_col)), algo)
