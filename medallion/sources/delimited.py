"""Delimited-text sources (S1-S6) and the header handling they need (TR3-TR6).

* Every raw column is read as text; a contract decides the types later.
* Values may be quoted; a quote inside a quoted value is doubled (``"a ""b"" c"``).  With
  ``multiline`` quoted values may hold line breaks, and files are still read in splits
  (``sources.quoted``); without it, a record is a line.
* Header names are canonicalised: Windows-1252 files read as ISO-8859-1 carry
  C1 control characters where cp1252 has punctuation (the en dash arrives as
  U+0096), so those are mapped back; a BOM and surrounding blanks are removed.
* A folder of files is read as one table **by header name**: files are grouped
  by their header line and each group is one ``spark.read.csv`` scan; the scans
  are then unioned by name.  Spark's multi-file CSV read matches columns by
  position, which silently swaps data when two files order their columns
  differently (TR3).
* A row with more or fewer fields than its header keeps its whole line in
  ``_malformed_line`` (null for all other rows), so that nothing is lost unseen.
  ``read_delimited`` does so where it is given the column's name, and otherwise
  refuses such a row with an error.
* Unnamed tail columns produced by a trailing separator (``_c14``) are dropped.
* UTF-16 files are read whole, one task for each file: their line ends are not
  single bytes, so they cannot be split.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.contracts import TableContract
from medallion.operators.union import union_all_by_name
from medallion.session import scratch_path
from medallion.sources import quoted

# Spark 4 refuses the Python-style names; these are the Java charset names.
CHARSET_ALIASES = {
    "utf8": "UTF-8", "utf-8": "UTF-8",
    "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "iso-8859-1": "ISO-8859-1",
    "cp1252": "ISO-8859-1", "windows-1252": "ISO-8859-1",
    "ascii": "UTF-8", "us-ascii": "UTF-8",
}

#: Holds the line of a row whose number of fields is not its header's.
MALFORMED = "_malformed_line"

_UNNAMED = re.compile(r"^_c\d+$")


def java_charset(encoding: str) -> str:
    """Map a Python-style encoding name to a charset the CSV reader accepts (TR2)."""
    return CHARSET_ALIASES.get(encoding.lower(), encoding)


def _c1_to_cp1252(ch: str) -> str:
    code = ord(ch)
    if 0x80 <= code <= 0x9F:
        mapped = bytes([code]).decode("cp1252", errors="ignore")
        return mapped or ch
    return ch


def _c1_table() -> tuple[str, str]:
    src, dst = [], []
    for code in range(0x80, 0xA0):
        mapped = bytes([code]).decode("cp1252", errors="ignore")
        if mapped:
            src.append(chr(code))
            dst.append(mapped)
    return "".join(src), "".join(dst)


C1_SOURCE, C1_TARGET = _c1_table()
CP1252_NAMES = {"cp1252", "windows-1252"}


def c1_values_to_cp1252(df: DataFrame) -> DataFrame:
    """Values of a cp1252 file read as ISO-8859-1: C1 controls back to cp1252 characters."""
    return df.select(*[
        F.translate(F.col(f"`{name}`"), C1_SOURCE, C1_TARGET).alias(name) if dtype == "string" else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ])


def canonical_header(name: str) -> str:
    """TR4: one spelling per header whatever the file's encoding."""
    name = name.replace("﻿", "").strip()
    return "".join(_c1_to_cp1252(ch) for ch in name)


def header_columns(header: str, sep: str) -> list[str]:
    """Column names of a header line: canonical, unnamed ones as ``_cN``, repeated ones numbered."""
    raw = next(csv.reader([header], delimiter=sep), [""]) if len(sep) == 1 else header.split(sep)
    names: list[str] = []
    for i, name in enumerate(map(canonical_header, raw)):
        name = name or f"_c{i}"
        names.append(f"{name}{i}" if name in names else name)
    return names


def canonicalise_columns(df: DataFrame, source_column: str | None = None) -> DataFrame:
    """Rename columns to their canonical header and drop unnamed tail columns (TR5).

    ``source_column`` adds the name of the file each row came from.
    """
    keep = [c for c in df.columns if not _UNNAMED.match(c) and c.strip() != ""]
    cols = [F.col(f"`{c}`").alias(canonical_header(c)) for c in keep]
    if source_column:
        cols.append(F.col("_metadata.file_name").alias(source_column))
    return df.select(*cols)


def is_utf16(encoding: str) -> bool:
    return java_charset(encoding).upper().startswith("UTF-16")


def _reader(spark: SparkSession, sep: str, encoding: str, header: bool = True, glob: str | None = None):
    reader = (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("encoding", java_charset(encoding))
        .option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if is_utf16(encoding):
        reader = reader.option("multiLine", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    header: bool = True,
    infer_schema: bool = False,
    schema: T.StructType | None = None,
    glob: str | None = None,
    source_column: str | None = None,
    malformed_column: str | None = None,
) -> DataFrame:
    """One scan of files that share a header.

    ``malformed_column`` adds a column that holds the lines of rows with surplus
    or missing fields (or values that are not of the schema's types); without it
    the read fails on such a row.

    ``schema`` (all strings, in file order) avoids the header-inference job;
    ``infer_schema`` is available but costs one extra pass over the data.
    ``glob`` picks files of a folder by name (S5) instead of by list position.
    ``encoding='windows-1252'`` reads as ISO-8859-1 (the charset Spark 4 accepts)
    and maps the C1 code points back to the cp1252 characters, in one
    ``translate`` per text column.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    # a pruned parser splits a line no further than it needs and would see no surplus field
    reader = _reader(spark, sep, encoding, header, glob).option("columnPruning", False)
    given = schema is not None
    if schema is None:
        schema = _reader(spark, sep, encoding, header, glob).option("inferSchema", infer_schema).csv(paths).schema
    if malformed_column:
        schema = T.StructType([*schema.fields, T.StructField(malformed_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", malformed_column)
    else:
        reader = reader.option("mode", "FAILFAST")
    reader = reader.schema(schema).option("enforceSchema", not given)
    df = canonicalise_columns(reader.csv(paths), source_column)
    if encoding.lower() in CP1252_NAMES:
        df = c1_values_to_cp1252(df)
    return df


def _scan(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str, names: Sequence[str], source_column: str | None,
          malformed: str | None, glob: str | None = None, recursive: bool = False, only: DataFrame | None = None) -> DataFrame:
    """Files that all have the columns ``names`` in this order; with ``only``, the files whose path it lists."""
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    reader = _reader(spark, sep, encoding, True, glob).option("recursiveFileLookup", recursive)
    if malformed:
        fields.append(T.StructField(malformed, T.StringType(), True))
        # a pruned parser splits a line no further than it needs and would see no surplus field
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", False)
    df = reader.schema(T.StructType(fields)).csv(list(paths))
    kept = [F.col(f"`{n}`") for n in (*names, *([malformed] if malformed else [])) if not _UNNAMED.match(n)]
    if source_column:
        kept.append(F.col("_metadata.file_name").alias(source_column))
    if only is not None:
        df = df.select(*kept, F.col("_metadata.file_path").alias("__path")).join(only, F.col("__path") == only["path"], "left_semi").drop("__path")
    else:
        df = df.select(*kept)
    return c1_values_to_cp1252(df) if encoding.lower() in CP1252_NAMES else df


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """File listing as a DataFrame (``path``, ``length``); no file content is read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "length")


def _header_text(head: Column, charset: Column) -> Column:
    """A file's first line as text in its charset, without BOM and line end."""
    raw = head.cast("binary")
    latin1 = F.decode(raw, "ISO-8859-1")
    even = F.substring(raw, F.lit(1), (F.length(raw) - F.length(raw) % 2).cast("int"))  # a big-endian line end leaves one byte
    text = (F.when(charset == "UTF-16", F.decode(even, "UTF-16")).when(charset == "UTF-16LE", F.decode(even, "UTF-16LE"))
            .when(charset == "UTF-16BE", F.decode(even, "UTF-16BE"))
            .when(charset.isin("windows-1252", "ISO-8859-1"), F.translate(latin1, C1_SOURCE, C1_TARGET))
            .otherwise(F.make_valid_utf8(head)))
    return F.regexp_replace(F.replace(text, F.lit("\ufeff"), F.lit("")), "\r$", "")


def file_index(spark: SparkSession, folders: Sequence[str], encoding: str, glob: str | None = None) -> DataFrame:
    """(path, charset, header) of every file with a line, made on the executors.

    One pass over the files with Spark's text source: the first line of each
    file, and with ``encoding='auto'`` what its lines say about its charset.
    """
    from medallion.sources.charset import encoding_label, file_facts, spark_charset

    facts = file_facts(spark, folders, glob, heads_only=encoding != "auto")
    if encoding == "auto":
        label = encoding_label()
        charset = F.when(label == "windows-1252", label).otherwise(spark_charset(label))
    else:
        charset = F.lit("windows-1252" if encoding.lower() in CP1252_NAMES else java_charset(encoding))
    return facts.select("path", charset.alias("charset"), "head").select("path", "charset", _header_text(F.col("head"), F.col("charset")).alias("header"))


def _by_columns(rows: Iterable, sep: str) -> dict[tuple[str, tuple[str, ...]], list]:
    """Index rows by (charset, column names)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["charset"], tuple(header_columns(row["header"], sep))].append(row)
    return groups


def read_folder(
    spark: SparkSession,
    folder: str | Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    glob: str | None = None,
    source_column: str | None = "source_file",
    malformed_column: str | None = MALFORMED,
    multiline: bool = False,
    split_bytes: int = quoted.SPLIT_BYTES,
) -> DataFrame:
    """Every file below ``folder`` as one table, columns matched by name.

    The files' header lines are read and grouped on the executors; one row for
    each distinct (charset, header) reaches the driver, with the folders it is
    found in.  With one group the folder itself is scanned.  With several, each
    group scans its own folders; in a folder of several groups its files are
    picked by a semi-join with the index of files, which stays a table.

    ``encoding='auto'`` decides each file's charset in the same pass (S11
    feeding S1-S3).  ``malformed_column`` holds the lines of rows with surplus or
    missing fields; ``None`` leaves it out.

    ``multiline`` reads quoted values with line breaks, files in splits of ``split_bytes``.
    """
    folders = [folder] if isinstance(folder, str) else list(folder)
    if multiline and not is_utf16(encoding):  # UTF-16 files are read whole anyhow, line breaks in values included
        return _read_multiline(spark, folders, sep, encoding, glob, source_column, malformed_column, split_bytes)
    path = scratch_path(spark, "file-index")
    file_index(spark, folders, encoding, glob).withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).write.parquet(path)
    index = spark.read.parquet(path)
    found = index.groupBy("charset", "header").agg(F.collect_set("folder").alias("folders")).collect()
    if not found:
        raise FileNotFoundError(f"no files under {folders}")
    groups = _by_columns(found, sep)
    where = defaultdict(set)
    for key, rows in groups.items():
        for row in rows:
            for name in row["folders"]:
                where[name].add(key)
    parts = []
    for (charset, names), rows in sorted(groups.items(), key=lambda g: g[0]):
        scan = (sep, charset, names, source_column, malformed_column, glob)
        if len(groups) == 1:
            parts.append(_scan(spark, folders, *scan, recursive=True))
            continue
        own = sorted({f for row in rows for f in row["folders"]})
        alone = [unquote(f) for f in own if len(where[f]) == 1]
        mixed = [unquote(f) for f in own if len(where[f]) > 1]
        if alone:
            parts.append(_scan(spark, alone, *scan))
        if mixed:
            mine = index.where((F.col("charset") == charset) & F.col("header").isin([row["header"] for row in rows])).select("path")
            parts.append(_scan(spark, mixed, *scan, only=mine))
    return union_all_by_name(parts)


def _decoded(raw: Column, charset: str) -> Column:
    """Undecoded bytes as text."""
    if charset.upper() == "UTF-8":
        return F.make_valid_utf8(raw.cast("string"))
    text = F.decode(raw, "ISO-8859-1" if charset in CP1252_NAMES else charset)
    return F.translate(text, C1_SOURCE, C1_TARGET) if charset in CP1252_NAMES else text


def _read_multiline(spark: SparkSession, folders: Sequence[str], sep: str, encoding: str, glob: str | None, source_column: str | None,
                    malformed_column: str | None, split_bytes: int) -> DataFrame:
    """Records found by ``sources.quoted``, parsed by their file's header in one scan."""
    from medallion.sources.charset import encoding_label, file_facts, spark_charset

    rows = quoted.records(spark, folders, sep, glob, split_bytes)
    heads = rows.where("header").select("path", F.col("record").alias("head"))
    if encoding == "auto":
        label = encoding_label()
        facts = file_facts(spark, folders, glob).select(F.col("path").alias("of"), F.when(label == "windows-1252", label).otherwise(spark_charset(label)).alias("charset"))
        heads = heads.join(facts, heads["path"] == facts["of"]).drop("of")
    else:
        heads = heads.withColumn("charset", F.lit("windows-1252" if encoding.lower() in CP1252_NAMES else java_charset(encoding)))
    found = heads.select("charset", "head").distinct().collect()
    if not found:
        raise FileNotFoundError(f"no records under {folders}")
    if any(is_utf16(r["charset"]) for r in found):
        raise ValueError("UTF-16 files cannot be read in splits: read them by themselves, with their encoding given")
    groups: dict[tuple[str, tuple[str, ...]], list[bytes]] = defaultdict(list)
    for r in found:
        groups[r["charset"], tuple(header_columns(_header_of(bytes(r["head"]), r["charset"]), sep))].append(bytes(r["head"]))
    keys = sorted(groups)
    data = rows.where(~F.col("header"))
    if len(keys) > 1:  # one row for each file
        group = F.coalesce(*(F.when((F.col("charset") == key[0]) & F.col("head").isin(groups[key]), F.lit(i)) for i, key in enumerate(keys)))
        data = data.join(heads.select(F.col("path").alias("of"), group.alias("group")), F.col("path") == F.col("of")).drop("of")
    else:
        data = data.withColumn("group", F.lit(0))
    wanted = list(dict.fromkeys(n for _, names in keys for n in names if not _UNNAMED.match(n)))
    kinds = [_parsed(F.col("record"), charset, names, wanted, sep, F.col("closed")) for charset, names in keys]
    values = kinds[0] if len(kinds) == 1 else F.coalesce(*(F.when(F.col("group") == i, v) for i, v in enumerate(kinds)))
    kept = [F.col(f"value.`{n}`") for n in wanted]
    if malformed_column:
        kept.append(F.col(f"value.`{MALFORMED}`").alias(malformed_column))
    if source_column:
        kept.append(F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias(source_column))
    return data.select("path", values.alias("value")).select(*kept)


def _header_of(raw: bytes, charset: str) -> str:
    return raw.decode({"windows-1252": "cp1252"}.get(charset, charset), errors="replace")


def _parsed(raw: Column, charset: str, names: Sequence[str], wanted: Sequence[str], sep: str, closed: Column) -> Column:
    """A record's values under the names wanted, and its text if its fields are not its header's or it never ends."""
    text = _decoded(raw, charset)
    fields = T.StructType([T.StructField(n, T.StringType()) for n in (*(f"f{i}" for i in range(len(names))), MALFORMED)])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    value = F.from_csv(text, fields.simpleString(), options)
    by_name = {n: value[f"f{i}"] for i, n in enumerate(names)}
    return F.struct(*(by_name.get(n, F.lit(None).cast("string")).alias(n) for n in wanted),
                    F.coalesce(value[MALFORMED], F.when(~closed, text)).alias(MALFORMED))


def read_files(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str = "UTF-8", source_column: str | None = "source_file",
               malformed_column: str | None = MALFORMED) -> DataFrame:
    """The listed files (a bounded number, e.g. of one micro-batch) as one table, columns matched by name."""
    rows = file_index(spark, list(paths), encoding).collect()
    if not rows:
        raise FileNotFoundError(f"no lines in {list(paths)[:3]}")
    return union_all_by_name([
        _scan(spark, sorted(unquote(r["path"]) for r in group), sep, charset, names, source_column, malformed_column)
        for (charset, names), group in sorted(_by_columns(rows, sep).items(), key=lambda g: g[0])])


def malformed_rows(df: DataFrame, by: str = "source_file") -> DataFrame:
    """Audit by file: rows, rows whose number of fields is not their header's, rows with a first field.

    (Spark refuses to read nothing but the malformed lines, so a data column is counted too.)
    """
    first = next(c for c in df.columns if c not in (by, MALFORMED))
    return df.groupBy(by).agg(F.count("*").alias("total"), F.count(MALFORMED).alias("malformed"), F.count(f"`{first}`").alias("first_field"))


def conform(df: DataFrame, contract: TableContract, keep: Sequence[str] = ("source_file", MALFORMED)) -> DataFrame:
    """Project a raw read onto the contract's raw columns, in contract order.

    Raw columns absent from the files (e.g. ``Segmento`` in a file that has
    ``CNPJ``) become null text, so later layers always see the same schema.
    """
    cols = [
        (F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")).alias(name)
        for name in contract.raw_names
    ]
    cols += [F.col(k) for k in keep if k in df.columns]
    return df.select(*cols)


def read_contract(
    spark: SparkSession,
    folder: str | Sequence[str],
    contract: TableContract,
    encoding: str | None = None,
    glob: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """A contract's raw table from a folder of delimited files."""
    df = read_folder(spark, folder, sep=contract.sep, encoding=encoding or contract.encoding, glob=glob, multiline=multiline)
    return conform(df, contract)
