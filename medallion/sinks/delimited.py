"""Delimited-text sink: raw files in the sources' own dialects.

Used to publish raw extracts and to produce the tab / pipe / semicolon files
the raw layer ingests.  Blanks are written as they are (Spark trims them by
default when writing), and a cp1252 file is produced the way Spark can: text
written as ISO-8859-1 with cp1252 punctuation put at its C1 code point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.sources.delimited import java_charset


def _to_c1(text: str) -> str:
    out = []
    for ch in text:
        try:
            b = ch.encode("cp1252")
        except UnicodeEncodeError:
            out.append(ch)
            continue
        out.append(chr(b[0]) if len(b) == 1 and 0x80 <= b[0] <= 0x9F else ch)
    return "".join(out)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str,
    encoding: str = "UTF-8",
    mode: str = "errorifexists",
    trailing_separator: bool = False,
    cp1252_headers: bool = False,
) -> str:
    """Write ``df`` as delimited text with a header line in every part file.

    ``trailing_separator`` adds the unnamed empty last column some exports
    carry (read back as ``_cN`` and dropped by the reader).  ``cp1252_headers``
    moves cp1252 punctuation in the header to its C1 code point so that the
    ISO-8859-1 writer emits the cp1252 byte.
    """
    out = df
    if cp1252_headers:
        out = out.select(*[F.col(f"`{c}`").alias(_to_c1(c)) for c in out.columns])
    if trailing_separator:
        out = out.withColumn("", F.lit(None).cast("string"))
    (
        out.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", java_charset(encoding))
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
