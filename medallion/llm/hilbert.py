"""Shards along a Hilbert curve (operator 6): DataFrame functions only.

Several metadata columns are quantised to ``bits`` bits each, all of them in their own order (numbers
by equal widths, labels by boundaries of equal depth, so that a shard's smallest and
largest label say what it can hold), the cells are numbered
along a Hilbert curve, rows are sorted by that number, and the order is cut into runs of
equal row counts.  Rows that are near in all the columns are near on the curve, so a
shard covers a small box in each of them: its smallest and largest values (see
``shard_bounds``) prune whole shards for a filter on any of the columns.

The curve is walked by a finite automaton: in a cell of orientation s, the d bits that
choose a sub-cell give d bits of the curve index and the sub-cell's orientation.  The
transition table follows from reflections and rotations of the Gray code.

Ranks without one task seeing all rows: rows are globally sorted and written with their
partition and place; the partitions' row counts are summed up (one row for each
partition), and rank = rows before the partition + place.

Defined results: a null or empty text has 0 text bytes and the CRC of no bytes; null
values of a metadata column share one cell with the smallest values; ties are broken by id, then by
CRC, and rows alike in all of these are interchangeable; an empty table has no rows.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import scratch_path
from medallion.sources.jdbc import equi_depth_shares

SHARDS = 40
BITS = 5
#: Bytes that a row takes beside its text.
ROW_BYTES = 16


def _rotate(x: int, k: int, d: int) -> int:
    """x's d bits rotated right by k."""
    k %= d
    return (x >> k | x << (d - k)) & ((1 << d) - 1)


def transitions(d: int) -> tuple[list[int], list[int]]:
    """(curve digit, next orientation) at [orientation * 2^d + sub-cell]; orientation = entry corner * d + direction."""
    digit, following = [], []
    for entry in range(1 << d):
        for direction in range(d):
            for cell in range(1 << d):
                gray = _rotate(cell ^ entry, direction + 1, d)
                w = 0
                for k in range(d):  # the Gray code's inverse
                    w ^= gray >> k
                w &= (1 << d) - 1
                digit.append(w)
                # entry corner and direction of the w-th sub-cell
                even = 2 * ((w - 1) // 2) if w else 0
                corner = even ^ even >> 1
                turn = 0 if w == 0 else _trailing_ones(w - 1 if w % 2 == 0 else w) % d
                new_entry = entry ^ _rotate(corner, d - (direction + 1), d)
                following.append(new_entry * d + (direction + turn + 1) % d)
    return digit, following


def _trailing_ones(x: int) -> int:
    n = 0
    while x & 1:
        x >>= 1
        n += 1
    return n


def curve_index(cells: list[Column], bits: int) -> Column:
    """The Hilbert number of a cell with ``bits`` bits in each of the columns."""
    d = len(cells)
    digit, following = transitions(d)
    digits, states = F.lit(digit), F.lit(following)
    levels = F.array(*(sum((F.shiftleft(F.shiftright(c, level).bitwiseAND(F.lit(1)), i) for i, c in enumerate(cells)), F.lit(0)).cast("int")
                       for level in reversed(range(bits))))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("index"))

    def walk(acc: Column, cell: Column) -> Column:
        at = acc["state"] * F.lit(1 << d) + cell
        return F.struct(F.get(states, at).alias("state"), (acc["index"] * F.lit(1 << d) + F.get(digits, at)).alias("index"))

    return F.aggregate(levels, start, walk, lambda acc: acc["index"])


def scaled(value: Column, low: float | None, high: float | None, bits: int) -> Column:
    """A number's cell among 2^bits of equal width between low and high."""
    if low is None or high is None or not high > low:
        return F.lit(0)
    cell = F.floor((value.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low)) * F.lit(float(1 << bits)))
    return F.coalesce(F.least(F.greatest(cell, F.lit(0)), F.lit((1 << bits) - 1)).cast("int"), F.lit(0))


def ranked(value: Column, shares: list[tuple[int, object]]) -> Column:
    """A label's cell: the share of the rows (of at most 2^bits) in which it or the next smaller boundary begins, so that cells keep the labels' order."""
    cell, before = F.lit(0), 0
    for share, boundary in shares:
        cell = cell + F.when(value >= F.lit(boundary), F.lit(int(share) - before)).otherwise(F.lit(0))
        before = int(share)
    return cell


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(ROW_BYTES)


def assign_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, id_column: str = "doc_id", text_column: str = "text",
                  labels: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot) of every row; the shards' row counts differ by at most one.

    Dimensions: the logarithm of the size, the id, and each column in ``labels`` by its order.
    """
    spark = docs.sparkSession
    text = docs[text_column]
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    narrow = docs.select(docs[id_column].alias("id"), size_of(text).alias("size"), crc.alias("text_crc32"),
                         *(docs[c].cast("string").alias(f"label{i}") for i, c in enumerate(labels)))
    kind = docs.schema[id_column].dataType.simpleString()
    number = F.col("id").cast("double") if kind in ("bigint", "int", "smallint", "tinyint") else F.xxhash64("id").cast("double")
    edge = narrow.agg(F.min("size"), F.max("size"), F.min(number), F.max(number)).first()
    sizes = [None if x is None else log2(x) for x in edge[:2]]
    cells = [scaled(F.log2(F.col("size")), *sizes, bits), scaled(number, edge[2], edge[3], bits),
             *(ranked(F.col(f"label{i}"), equi_depth_shares(narrow, f"label{i}", 1 << bits)) for i in range(len(labels)))]
    path = scratch_path(spark, "hilbert")
    # monotonically_increasing_id: the partition's number above 33 bits, the place in it below
    (narrow.select("id", "size", "text_crc32", curve_index(cells, bits).alias("curve"))
     .orderBy("curve", "id", "text_crc32").withColumn("at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("run", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("run").agg(F.count("*").alias("n"))  # one row for each partition of the sort
    runs = runs.select(F.col("run").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    total = rows.count()
    rank = F.col("base") + F.col("place")
    n = max(total, 1)
    numbered = (rows.join(F.broadcast(runs), rows["run"] == runs["r"]).withColumn("rank", rank)
                .withColumn("shard", F.expr(f"cast((rank * {shards}) div {n} as int)")))
    # the shard's first rank: the smallest r with floor(r * shards / total) = shard
    first = F.expr(f"(shard * bigint({n}) + {shards - 1}) div {shards}")
    return numbered.select(F.col("id").alias(id_column), "size", "text_crc32", "curve", "shard", (F.col("rank") - first).alias("slot"))


def shard_bounds(assigned: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest and largest value of the columns in each shard, and its rows: what a reader prunes by."""
    return assigned.groupBy("shard").agg(F.count("*").alias("rows"), *(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))))
