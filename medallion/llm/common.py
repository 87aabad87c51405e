"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one slice handed to an operator's kernel, and the text bytes at which
#: a slice ends earlier.  They bound a task's memory; no row is dropped or cut.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(id_column: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary())
    return column.to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str, rows: int = SLICE_ROWS,
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Record batches cut into slices of bounded rows and text bytes, with the text as bytes.

    A single row over the byte limit is a slice of its own: whole, never cut.
    """
    for batch in batches:
        texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        start = size = 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if i > start and (i - start >= rows or size + n > limit):
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += n
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def segments(lengths: np.ndarray) -> np.ndarray:
    """For pieces of these lengths laid end to end, the piece of every element."""
    return np.repeat(np.arange(len(lengths)), lengths)


def within(lengths: np.ndarray) -> np.ndarray:
    """For pieces of these lengths laid end to end, every element's place in its piece."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def hash_share(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1: rows below a share are a sample of that share, the same each time."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))
