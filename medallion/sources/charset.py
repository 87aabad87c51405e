"""Encoding of each file in a folder, decided on the executors.

The text source hands each line over as raw bytes (no decoding), so per line
we can ask Spark's own ``is_valid_utf8`` and look at the byte values through a
Latin-1 view of the same bytes.  Per file the lines' facts are combined with
``bool_and`` / ``bool_or`` / ``sum`` -- a partial aggregation, so a file of any
size is split across tasks and only one row per file leaves the map side.

Labels: ``utf-16`` (a byte-order mark), ``utf-16le`` / ``utf-16be`` (no mark, but
NULs are at least 30 % of all bytes, as in UTF-16 text of mostly Latin letters;
the first line's NULs say which byte comes first), ``ascii`` (no byte over
0x7F), ``utf-8`` (valid UTF-8, a stray NUL allowed), ``windows-1252`` (not UTF-8
and uses bytes 0x80-0x9F, which are printable only in cp1252) and
``iso-8859-1`` (not UTF-8, no C1 bytes).  ``spark_charset`` gives the charset to
pass to the CSV reader for each label.

``confidence`` says how far the bytes bear the label out.  Every pair of neighbouring bytes
with one over 0x7F is scored under each single-byte charset that might have been used: the pair's
two characters have a class there (lower or upper case, with or without accent, digit, blank,
punctuation, rare sign, control), one class follows another with some probability, and a class's characters share it
equally.  The label's share of all likelihoods is its confidence.  Charsets that agree on all
the bytes seen share it, so Latin-1 text that would read the same as windows-1252 gets a low
one, and text in a charset that no label stands for (``cp850``, ``mac_roman``) one near 0.
The scores are sums over lines and come from the same aggregation.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Detected label -> charset the Spark 4 CSV reader accepts.
SPARK_CHARSET = {
    "utf-16": "UTF-16",
    "utf-16le": "UTF-16LE",
    "utf-16be": "UTF-16BE",
    "ascii": "UTF-8",
    "utf-8": "UTF-8",
    "windows-1252": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
}

#: Share of NUL bytes from which a file without a byte-order mark is UTF-16.
NUL_SHARE = 0.3


#: Single-byte charsets that compete; the last three are never a label.
RIVALS = ("windows-1252", "iso-8859-1", "iso-8859-15", "cp850", "mac_roman")

_CONTROL, _BLANK, _DIGIT, _LOWER, _UPPER, _PUNCTUATION, _SIGN, _ACCENTED, _ACCENTED_UPPER = _CLASSES = range(9)
# How often one class follows another in Western text (rows: from).
_FOLLOWS = (
    (0.12, 0.11, 0.11, 0.11, 0.11, 0.11, 0.11, 0.11, 0.11),
    (1e-6, 0.10, 0.08, 0.47, 0.25, 0.06, 0.01, 0.02, 0.01),
    (1e-6, 0.25, 0.50, 0.05, 0.02, 0.17, 0.005, 0.003, 0.002),
    (1e-6, 0.17, 0.005, 0.70, 0.01, 0.06, 0.005, 0.05, 0.0005),
    (1e-6, 0.12, 0.02, 0.50, 0.25, 0.05, 0.005, 0.04, 0.015),
    (1e-6, 0.55, 0.10, 0.12, 0.10, 0.10, 0.01, 0.01, 0.01),
    (1e-6, 0.40, 0.10, 0.15, 0.10, 0.10, 0.10, 0.03, 0.02),
    (1e-6, 0.10, 0.002, 0.80, 0.003, 0.05, 0.003, 0.04, 0.002),
    (1e-6, 0.05, 0.005, 0.50, 0.35, 0.02, 0.005, 0.02, 0.05),
)
# Characters of each class, alike in all charsets so that those that agree on a text tie.
_SIZES = (40, 10, 10, 26, 26, 35, 40, 35, 35)
# A non-ASCII character of valid UTF-8, any of some hundred common ones.
_UTF8_CHARACTER = math.log(0.75 / 100)


def _class_of(byte: int, codec: str) -> int:
    char = bytes([byte]).decode(codec, errors="ignore")
    if not char:
        return _CONTROL
    kind = unicodedata.category(char)
    if char.isspace():
        return _BLANK
    if kind == "Nd":
        return _DIGIT
    if kind in ("Ll", "Lu"):
        return {("Ll", True): _LOWER, ("Lu", True): _UPPER, ("Ll", False): _ACCENTED, ("Lu", False): _ACCENTED_UPPER}[kind, byte < 0x80]
    if kind[0] == "C":
        return _CONTROL
    return _PUNCTUATION if kind[0] == "P" else _SIGN


def pair_scores(codec: str) -> tuple[list[int], list[float]]:
    """Class of every byte, and the log likelihood of a byte of the second class after one of the first, at 9 * first + second."""
    return [_class_of(b, codec) for b in range(256)], [math.log(p / _SIZES[b]) for row in _FOLLOWS for b, p in enumerate(row)]


def _pairs(latin1: Column) -> Column:
    """Codes of neighbouring bytes of a line, one of them over 0x7F; blanks stand around the line."""
    around = F.concat(F.lit(" "), latin1, F.lit(" "))
    found = F.regexp_extract_all(around, F.lit(r"(?s)(?=([\x80-\xff].|.[\x80-\xff]))"), F.lit(1))
    return F.when(latin1.rlike("[\\x80-\\xff]"), F.transform(found, lambda p: F.struct(F.ascii(p).alias("a"), F.ascii(F.substring(p, 2, 1)).alias("b"))))


def _score(pairs: Column, codec: str) -> Column:
    classes, likelihoods = (F.lit(x) for x in pair_scores(codec))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.get(likelihoods, F.get(classes, p["a"]) * len(_CLASSES) + F.get(classes, p["b"])))


def confidence(label: Column) -> Column:
    """The label's share of the likelihoods of a row of ``file_facts``."""
    wide = F.when(F.hex(F.substring(F.col("head").cast("binary"), 1, 2)).isin("FFFE", "FEFF"), F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * F.col("nuls") / F.col("bytes")))
    own = F.coalesce(*(F.when(label == r, F.col(f"score_{r}")) for r in RIVALS[:2]), F.col("score_utf8"))
    all_of = sum((F.exp(F.col(f"score_{r}") - own) for r in RIVALS), F.when(F.col("utf8"), F.exp(F.col("score_utf8") - own)).otherwise(F.lit(0.0)))
    return F.round(F.when(label.startswith("utf-16"), wide).when(label == "ascii", F.lit(1.0)).otherwise(F.lit(1.0) / all_of), 4)


def file_facts(spark: SparkSession, folders: str | Sequence[str], glob: str | None = None, heads_only: bool = False) -> DataFrame:
    """Per file: ``path``, its first line ``head`` (undecoded) and, unless ``heads_only``, what its bytes are."""
    reader = spark.read.format("text").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(folders if isinstance(folders, str) else list(folders)).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    head = F.min_by(F.when(F.col("start") == 0, F.col("value")), F.when(F.col("start") == 0, F.col("at"))).alias("head")
    if heads_only:
        return lines.where("start = 0").groupBy("path").agg(head)
    latin1 = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    nuls = F.length(latin1) - F.length(F.replace(latin1, F.lit("\x00"), F.lit("")))
    beyond_ascii = F.when(F.is_valid_utf8("value"), F.length(F.regexp_replace("value", "[\\x00-\\x7f]", "")))
    return lines.withColumn("pairs", _pairs(latin1)).groupBy("path").agg(
        head,
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(latin1.rlike("[\\x80-\\x9f]")).alias("c1"),
        F.bool_or(latin1.rlike("[^\\x00-\\x7f]")).alias("high"),
        F.sum(nuls).alias("nuls"),
        F.sum(F.length(latin1)).alias("bytes"),
        F.count(F.lit(1)).alias("lines"),
        *(F.coalesce(F.sum(_score(F.col("pairs"), r)), F.lit(0.0)).alias(f"score_{r}") for r in RIVALS),
        (F.coalesce(F.sum(beyond_ascii), F.lit(0)) * F.lit(_UTF8_CHARACTER)).alias("score_utf8"),
    )


def encoding_label() -> Column:
    """The label of a row of ``file_facts``."""
    first = F.hex(F.substring(F.col("head").cast("binary"), 1, 2))
    wide = F.col("nuls") >= F.col("bytes") * NUL_SHARE
    return (
        F.when(first.isin("FFFE", "FEFF"), F.lit("utf-16"))
        .when((F.col("nuls") > 0) & wide & first.startswith("00"), F.lit("utf-16be"))
        .when((F.col("nuls") > 0) & wide, F.lit("utf-16le"))
        .when(~F.col("high"), F.lit("ascii"))
        .when(F.col("utf8"), F.lit("utf-8"))
        .when(F.col("c1"), F.lit("windows-1252"))
        .otherwise(F.lit("iso-8859-1"))
    )


def spark_charset(label: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in SPARK_CHARSET.items() for x in kv])[label]


def encoding_audit(spark: SparkSession, folder: str, glob: str | None = None, by: str = "file") -> DataFrame:
    """One row per file (``by='file'`` names it, ``by='path'`` gives its full
    path), or per parent folder and encoding (``by='folder'``).

    Columns: the group (``file_name`` / ``file_path`` / ``folder``), ``encoding``, its
    ``confidence``, ``spark_charset`` and ``lines``.
    """
    facts = file_facts(spark, folder, glob).withColumn("encoding", encoding_label())
    charset, sure = spark_charset(F.col("encoding")).alias("spark_charset"), confidence(F.col("encoding")).alias("confidence")
    if by == "folder":
        # the label of a folder's files together, as if they were one
        parent = F.element_at(F.split("path", "/"), -2)
        joined = facts.groupBy(parent.alias("folder")).agg(
            F.min("head").alias("head"), F.bool_and("utf8").alias("utf8"), F.bool_or("c1").alias("c1"), F.bool_or("high").alias("high"),
            F.sum("nuls").alias("nuls"), F.sum("bytes").alias("bytes"), F.sum("lines").alias("lines"),
            *(F.sum(c).alias(c) for c in facts.columns if c.startswith("score_")))
        return joined.withColumn("encoding", encoding_label()).select("folder", "encoding", sure, charset, "lines")
    name = F.col("path").alias("file_path") if by == "path" else F.element_at(F.split("path", "/"), -1).alias("file_name")
    return facts.select(name, "encoding", sure, charset, "lines")
