"""Ranked lexical search from the items' side (operator 13).

The items (queries) are few and the documents many, so the usual roles are turned round:
an inverted index over the *items'* terms is broadcast, every document is read once, its
counts of those terms are run through the index, and each item keeps a bounded heap of its
best documents in every task.  The tasks' heaps are merged by two ranked cuts (first within
``MERGE_WAYS`` groups of documents, then over all of them), so no task sees more than the
winners of other tasks.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms with repeats (a longer item is a
block by itself): that bounds the broadcast index and the heaps.  Every block is two passes
over the documents: term statistics, then scores; its winners are written before the
next block begins.

Weights: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 75 + (25 n N) div L, and a document
scores the sum over the item's terms, repeats included, of
w ((1000000000 tf) div (1000 tf + 12 m)); all of it in 64-bit integers but for the logarithm.

Defined results: terms are maximal runs of ASCII letters and digits and of everything beyond
ASCII, only A-Z lower-cased; a null or empty text has none and does not count as a document,
neither is it found; equal scores are ordered by ascending id, a null id last, and rows
alike in both are interchangeable; every row of the items is a query of its own, also with a
repeated or null id; a text or an item of any length is taken whole; without items or
documents there are no rows; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import segments, slices, within
from medallion.session import scratch_path

TOP = 20
BLOCK_TERMS = 1 << 17
MERGE_WAYS = 32
#: (slice of documents) x items held as one matrix of scores at a time.
MATRIX_CELLS = 1 << 21

# A-Z to lower case; ASCII other than letters and digits to spaces.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERMS).split() if text else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Index:
    """Term numbers, and for every term the items that hold it and how often."""

    def __init__(self, items: list[list[bytes]]):
        self.number: dict[bytes, int] = {}
        posted: list[dict[int, int]] = []
        for i, terms in enumerate(items):
            for t in terms:
                k = self.number.setdefault(t, len(self.number))
                if k == len(posted):
                    posted.append({})
                posted[k][i] = posted[k].get(i, 0) + 1
        self.items = len(items)
        self.length = np.array([len(p) for p in posted], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.item = np.array([i for p in posted for i in p], np.int64)
        self.times = np.array([c for p in posted for c in p.values()], np.int64)

    def counts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All terms of every text; and text, term and occurrences of each indexed term in it."""
        look, size = self.number.get, max(len(self.number), 1)
        lengths, texts_at, found = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            terms = terms_of(text)
            lengths[i] = len(terms)
            ids = [k for k in map(look, terms) if k is not None]
            texts_at.append(len(ids))
            found += ids
        pairs, tf = np.unique(segments(np.array(texts_at, np.int64)) * size + np.array(found, np.int64), return_counts=True)
        return lengths, pairs // size, pairs % size, tf.astype(np.int64)


class _Entry:
    """A scored document; the smallest entry is the one to give up first."""

    __slots__ = ("score", "id")

    def __init__(self, score: int, doc_id: object):
        self.score, self.id = score, doc_id

    def __lt__(self, other: _Entry) -> bool:
        if self.score != other.score:
            return self.score < other.score
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id


class Heaps:
    """The best ``top`` documents of every item so far."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        #: What a document has to reach at least to be looked at.
        self.floor = np.ones(items, np.int64)

    def update(self, scores: np.ndarray, ids: list) -> None:
        """scores: one row a document, one column an item."""
        for d, i in zip(*(x.tolist() for x in np.nonzero(scores >= self.floor))):
            heap, entry = self.heaps[i], _Entry(int(scores[d, i]), ids[d])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif heap[0] < entry:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.floor[i] = heap[0].score


def _statistics(index, id_column, text_column):
    """Each task's document frequency of every indexed term; at -1 its documents, at -2 their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, n, total = index.value, 0, 0
        df = np.zeros(len(x.number), np.int64)
        for _, texts in slices(batches, text_column):
            lengths, _, terms, _ = x.counts(texts)
            df += np.bincount(terms, minlength=len(df))
            n, total = n + int((lengths > 0).sum()), total + int(lengths.sum())
        at = np.flatnonzero(df)
        yield pa.record_batch([np.concatenate([[-1, -2], at]), np.concatenate([[n, total], df[at]])], names=["term", "n"])
    return run


def _scores(x: Index, weights: np.ndarray, n: int, total: int, texts: list[bytes | None]) -> np.ndarray:
    """Score of every text for every item."""
    lengths, doc, term, tf = x.counts(texts)
    m = 75 + np.array([25 * k * n // total for k in lengths.tolist()], np.int64)
    gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
    reach = x.length[term]
    at = np.repeat(x.start[term], reach) + within(reach)
    scores = np.zeros(len(texts) * x.items, np.int64)
    np.add.at(scores, np.repeat(doc, reach) * x.items + x.item[at], np.repeat(gain, reach) * x.times[at])
    return scores.reshape(len(texts), x.items)


def _search(index, known, top, id_column, text_column, id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, (weights, n, total) = index.value, known.value
        heaps = Heaps(x.items, top)
        for batch, texts in slices(batches, text_column, rows=max(1, min(512, MATRIX_CELLS // max(x.items, 1)))):
            heaps.update(_scores(x, weights, n, total, texts), batch.column(batch.schema.get_field_index(id_column)).to_pylist())
        found = [(i, e.id, e.score) for i, heap in enumerate(heaps.heaps) for e in heap]
        cols = list(zip(*found)) or [(), (), ()]
        yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], id_type), pa.array(cols[2], pa.int64())], names=["item", "doc", "score"])
    return run


def _blocks(items: Iterator, limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    block, size = [], 0
    for item_id, text in items:
        terms = terms_of(text.encode() if text is not None else None)
        if block and size + len(terms) > limit:
            yield block
            block, size = [], 0
        block.append((item_id, terms))
        size += len(terms) + 1
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, id_column: str = "doc_id",
           text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item id, rank, id, score) of every item's best ``top`` documents with a score above zero."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_column].dataType, items.schema[item_column].dataType
    rows = docs.select(docs[id_column].alias("doc"), docs[text_column].alias("text"))
    path, written = scratch_path(spark, "reversed-search"), []
    # toLocalIterator: one partition of the items at a time on the driver, one block of them kept
    for number, block in enumerate(_blocks(items.select(item_column, item_text).toLocalIterator(), block_terms)):
        x = Index([terms for _, terms in block])
        index = spark.sparkContext.broadcast(x)
        counted = {r["term"]: r["n"] for r in rows.mapInArrow(_statistics(index, "doc", "text"), "term bigint, n bigint")
                   .groupBy("term").agg(F.sum("n").alias("n")).collect()}
        n, total = counted.get(-1, 0), counted.get(-2, 0)
        weights = np.array([weight(n, counted.get(k, 0)) for k in range(len(x.number))], np.int64)
        known = spark.sparkContext.broadcast((weights, n, max(total, 1)))
        found = rows.mapInArrow(_search(index, known, top, "doc", "text", to_arrow_type(id_type)),
                                f"item bigint, doc {id_type.simpleString()}, score bigint")
        best = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
        part = F.pmod(F.xxhash64("doc"), F.lit(MERGE_WAYS)).alias("part")
        some = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*best))).where(F.col("rank") <= top)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item bigint, item_id {item_type.simpleString()}")
        (ranked.join(F.broadcast(names), "item")  # the block's ids: at most block_terms of them
         .select(F.col("item_id").alias(item_column), "rank", F.col("doc").alias(id_column), "score")
         .write.parquet(f"{path}/{number}"))
        written.append(f"{path}/{number}")
        index.unpersist()
        known.unpersist()
    schema = f"`{item_column}` {item_type.simpleString()}, rank int, `{id_column}` {id_type.simpleString()}, score bigint"
    return spark.read.schema(schema).parquet(*written) if written else spark.createDataFrame([], schema)
