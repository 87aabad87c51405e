"""Document fingerprints by prefix polynomial hashes (operator 10).

For a text of code points c0 c1 ... the prefix array holds S[i] = sum of (c[j] + 1) B^j
over j < i, modulo two primes.  Any span's hash follows from two entries, so the
equality of two spans, in one text or in two, takes constant time after multiplying
both to the same power of B; the longest common extension of two positions, forwards or
backwards, is found by binary search over span equality.

A document's fingerprint is the hash of its whole text with its length.  The likeness of
two documents is the number of code points in equal spans, which do not overlap, over the
longer length: 1 for equal texts, and by definition for two empty ones.  The spans are the
longest common extensions at their beginnings and at their ends, and between these the
extensions, both ways, of equal spans of ``ANCHOR`` code points, wherever they stand.
Equal spans of ``ANCHOR + STEP - 1`` code points or more are always found, those shorter
than ``ANCHOR`` never: unrelated texts of one language have phrases in common.  A span of
a text that repeats itself may be matched with a shifted copy, short of fewer than
``ANCHOR + STEP`` code points.

The documents are range-partitioned by descending id.  A document's successor is the
next row of its partition; the successor of a partition's last document is the first one
of the next partition, which is sent along as a second copy (one row for each partition).

Ids are numbers, texts or dates.  Defined results: a null text is the empty one.  Repeated ids are ordered by text; null
ids come last.  A document that is alone is its own successor.  Longer texts take memory
in proportion to their length, one document at a time.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from medallion.llm.common import slices
from medallion.sources.jdbc import equi_depth_boundaries

#: Two primes under 2^31 and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (1103515245, 1812433253)
#: Code points of the equal spans by which texts are aligned past a difference, and from one to the next in the first text.
ANCHOR, STEP = 64, 16


@functools.lru_cache(maxsize=40)  # one for each doubling of the length
def _powers_of(bits: int) -> np.ndarray:
    """B^0 ... B^(2^bits - 1) modulo both primes, by doubling."""
    if bits == 0:
        return np.ones((2, 1), np.uint64)
    p = np.array(MODULI, np.uint64)[:, None]
    out = np.ones((2, 1), np.uint64)
    step = np.array(BASES, np.uint64)[:, None]
    for _ in range(bits):
        out = np.concatenate([out, out * step % p], axis=1)
        step = step * step % p
    return out


def powers(n: int) -> np.ndarray:
    return _powers_of(max(10, int(n).bit_length()))


class Prefixes:
    """A text's code points and prefix hashes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.sums = np.zeros((2, len(codes) + 1), np.uint64)
        self._extend(0)

    def _extend(self, start: int) -> None:
        n = len(self.codes)
        pw = powers(n)
        values = self.codes[start:].astype(np.uint64) + np.uint64(1)
        for k, p in enumerate(MODULI):
            terms = values * pw[k, start:n] % np.uint64(p)
            if len(terms):
                terms[0] += self.sums[k, start]
            # sums of fewer than 2^32 terms under 2^31 stay under 2^63
            self.sums[k, start + 1:] = np.cumsum(terms) % np.uint64(p)

    def replaced_tail(self, keep: int, tail: np.ndarray) -> Prefixes:
        """The first ``keep`` code points followed by others: the kept prefix hashes are not computed again."""
        out = Prefixes.__new__(Prefixes)
        out.codes = np.concatenate([self.codes[:keep], tail])
        out.sums = np.empty((2, len(out.codes) + 1), np.uint64)
        out.sums[:, :keep + 1] = self.sums[:, :keep + 1]
        out._extend(keep)
        return out

    def __len__(self) -> int:
        return len(self.codes)

    def span(self, begin: int, length: int) -> tuple[int, int]:
        """The span's hash, still times B^begin."""
        a, b = self.sums[:, begin].tolist(), self.sums[:, begin + length].tolist()
        return (b[0] - a[0]) % MODULI[0], (b[1] - a[1]) % MODULI[1]

    def fingerprint(self) -> str:
        a, b = self.sums[:, -1].tolist()
        return f"{a:08x}{b:08x}{len(self):08x}"

    def text(self) -> bytes:
        return self.codes.tobytes().decode("utf-32-le").encode("utf-8")


def spans_equal(x: Prefixes, i: int, y: Prefixes, j: int, length: int) -> bool:
    """Whether x[i : i + length] and y[j : j + length] have the same hash."""
    if i == j:
        return x.span(i, length) == y.span(j, length)
    pw = powers(max(len(x), len(y)))
    a, b = x.span(i, length), y.span(j, length)
    up = pw[:, j - i].tolist() if j > i else pw[:, i - j].tolist()
    if j > i:
        return all(a[k] * up[k] % MODULI[k] == b[k] for k in (0, 1))
    return all(a[k] == b[k] * up[k] % MODULI[k] for k in (0, 1))


def common_extension(x: Prefixes, i: int, y: Prefixes, j: int, backwards: bool = False, limit: int | None = None) -> int:
    """Length of the longest equal spans (up to ``limit``) that begin (or, backwards, end) at i and j, by binary search."""
    low, high = 0, min(i, j) if backwards else min(len(x) - i, len(y) - j)
    high = high if limit is None else min(high, limit)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(x, i - middle, y, j - middle, middle) if backwards else spans_equal(x, i, y, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _anchors(x: Prefixes, at: np.ndarray, top: int) -> np.ndarray:
    """Hashes modulo the first prime of the spans of ``ANCHOR`` code points that begin at ``at``, all times B^top."""
    p = np.uint64(MODULI[0])
    return (x.sums[0, at + ANCHOR] + p - x.sums[0, at]) % p * powers(top)[0, top - at] % p


def matched_between(x: Prefixes, y: Prefixes, head: int, tail: int) -> int:
    """Code points in equal spans, without overlap, of what lies between the first ``head`` and the last ``tail`` code points."""
    x_end, y_end = len(x) - tail, len(y) - tail
    if min(x_end, y_end) - head < ANCHOR:
        return 0
    top = max(len(x), len(y))
    places = np.arange(head, x_end - ANCHOR + 1, STEP)
    hashes = _anchors(x, places, top)
    order = np.argsort(hashes, kind="stable")
    places, hashes = places[order], hashes[order]
    found = _anchors(y, np.arange(head, y_end - ANCHOR + 1), top)
    first = np.searchsorted(hashes, found)
    hits = np.flatnonzero(hashes[np.minimum(first, len(hashes) - 1)] == found)
    if not len(hits):
        return 0
    first = first[hits].tolist()
    hits = (hits + head).tolist()
    following: dict[int, int] = {}  # of equal anchors in x, the first that is not yet in a span
    taken: list[tuple[int, int]] = [(0, head), (x_end, len(x))]  # sorted spans of x
    matched, y_from, k = 0, head, 0
    while k < len(hits):
        j, begin = hits[k], first[k]
        k += 1
        at = following.get(begin, begin)
        while at < len(places) and hashes[at] == hashes[begin]:
            i = int(places[at])
            gap = bisect.bisect_right(taken, (i, len(x) + 1))
            low, high = taken[gap - 1][1], taken[gap][0]
            if low <= i and i + ANCHOR <= high:
                break
            at += 1  # it stays covered
        else:
            following[begin] = len(places)
            continue
        following[begin] = at
        ahead = common_extension(x, i, y, j, limit=min(high - i, y_end - j))
        if ahead < ANCHOR:
            continue  # equal modulo the first prime only
        back = common_extension(x, i, y, j, backwards=True, limit=min(i - low, j - y_from))
        matched += back + ahead
        taken.insert(gap, (i - back, i + ahead))
        y_from = j + ahead
        k = bisect.bisect_left(hits, y_from, k)
    return matched


def likeness(x: Prefixes, y: Prefixes) -> float:
    longest = max(len(x), len(y))
    if not longest:
        return 1.0
    head = common_extension(x, 0, y, 0)
    if head == longest:
        return 1.0
    tail = common_extension(x, len(x), y, len(y), backwards=True)
    tail = min(tail, min(len(x), len(y)) - head)
    return (head + tail + matched_between(x, y, head, tail)) / longest


def code_points(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32) if text else np.zeros(0, np.uint32)


def _larger(cuts: Column, count: int, value: Column) -> Column:
    """How many of the descending cuts are larger than the value, by binary search."""
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(count.bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) > value, at + step).otherwise(at))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", partitions: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text is the document with the last third of its code points (rounded down) replaced by as many
    of its successor's first ones, in the order of descending ids; the first follows the last.
    """
    spark = docs.sparkSession
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    want = partitions or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if want == 1:
        cuts = []
    elif isinstance(narrow.schema["id"].dataType, NumericType):
        cuts = narrow.select(F.percentile_approx("id", [i / want for i in range(1, want)], 10 * want)).first()[0]
    else:  # percentiles are for numbers
        cuts = equi_depth_boundaries(narrow, "id", want)
    cuts = sorted(set(cuts or []), reverse=True)
    # bucket 0 has the largest ids; null ids come after all others
    bucket = F.lit(len(cuts))
    if cuts:
        bucket = F.when(F.col("id").isNull(), F.lit(len(cuts))).otherwise(_larger(F.lit(cuts).cast(f"array<{kind}>"), len(cuts), F.col("id")))
    placed = narrow.withColumn("bucket", bucket.cast("int"))
    tops = {r["bucket"]: r["top"] for r in placed.groupBy("bucket").agg(F.max("id").alias("top")).collect()}  # one row a bucket
    filled = sorted(tops)
    follows = {b: filled[i - 1] for i, b in enumerate(filled)}  # bucket -> the one before it; the first one's is the last
    if not filled:
        return spark.createDataFrame([], f"{id_column} {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                         "edited_fingerprint string, near_edited double, near_next double")
    plan = spark.createDataFrame([(b, follows[b], tops[b]) for b in filled], f"b int, before int, top {kind}")
    # a bucket's first document goes to the bucket before it too, as the successor of its last one
    leads = (placed.join(F.broadcast(plan), (placed["bucket"] == plan["b"]) & placed["id"].eqNullSafe(plan["top"]))
             .select("id", "text", F.col("before").alias("bucket"), F.lit(1).alias("lead")))
    rows = placed.withColumn("lead", F.lit(0)).select("id", "text", "bucket", "lead").unionByName(leads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [arrow_kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        open_bucket, last = None, None
        for batch, texts in slices(batches, "text"):
            out: list[tuple] = []
            for key, where, lead, text in zip(*(batch.column(n).to_pylist() for n in ("id", "bucket", "lead")), texts):
                if where != open_bucket:
                    open_bucket, last = where, None
                elif last is None:
                    continue  # further copies of the leading document
                now = Prefixes(code_points(text))
                if last is not None:
                    out.append(_row(*last, now))
                last = None if lead else (key, now)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(narrow.schema["id"].dataType)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(count, "bucket").sortWithinPartitions(F.col("bucket"), F.col("lead"), F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
            .mapInArrow(run, f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                             "near_edited double, near_next double").withColumnRenamed("id", id_column))


def _row(key, own: Prefixes, following: Prefixes) -> tuple:
    third = len(own) // 3
    edited = own.replaced_tail(len(own) - third, following.codes[:third])
    return (key, len(own), hashlib.sha256(edited.text()).hexdigest(), own.fingerprint(), edited.fingerprint(),
            likeness(own, edited), likeness(own, following))
