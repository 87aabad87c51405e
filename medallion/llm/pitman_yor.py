"""Hierarchical Pitman-Yor language model (operator 9).

Restaurants: the root; one for each class of the previous word's ending; below each of
these, one for each bucket of the previous word itself, so that restaurants with the
same ending share their parent.  Classes and buckets are hashes with a fixed number of
values (``ENDINGS`` x ``BUCKETS``): the number of restaurants is bounded, the dishes
(words) and all their counts are not, and grow with the corpus.

Seating is sampled per word: given a restaurant's totals, the seats of different words do
not depend on each other.  So the tokens are dealt out by a hash of the word, a task holds
all restaurants' counts of its words, and only the totals (a number for each restaurant)
are summed up between rounds.  In a round every task seats the customers of its words by
the distribution that Gibbs steps over single customers lead to, leaves first; tables are the
customers of the parent.  Up to 512 customers of a word in a restaurant are seated by one draw
from it; more are seated anew from the round before's seats, all of them in every pass.  The
seats are written with the counts after every round, beside their totals.  The last round keeps several
samples; the predictive probabilities, each from a sample's seats and the totals of these
same seats, are averaged.

What is stored and shuffled are packed runs: for each flush of a task (a bounded number of
tokens) and each word group, the words, their contexts and the documents they stand in.
A word group that holds much more than the others (a word that makes up a third of all
tokens) is scored in several tasks, each with that group's counts and a share of the flushes.

Words are told apart by 64-bit hashes.  The base measure is uniform over the V training
words and one more that stands for all others.

Defined results: null and empty texts are one end token; repeated rows are scored (and
learned from) each by itself; without any training text every token has probability 1.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import segments, slices
from medallion.session import scratch_path

ENDINGS, BUCKETS = 64, 64
LEAVES = ENDINGS * BUCKETS
FLUSH_TOKENS = 1_000_000
#: Text bytes for each word group.
GROUP_BYTES = 24 << 20
ROUNDS, PASSES, SAMPLES = 2, 4, 3
#: Customers up to which tables are drawn from a table of all seatings' weights; seatings tried in a pass beyond; numbers held at a time.
FEW, TRIES, CELLS = 512, 8, 1 << 18
STRENGTH = 1.0


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of everything but ASCII white space."""
    return text.lower().split() if text else []


def context_of(word: bytes) -> int:
    """The restaurant for what follows this word: its ending's class, then the word's bucket."""
    return xxhash.xxh32_intdigest(word[-2:], 5) % ENDINGS * BUCKETS + xxhash.xxh32_intdigest(word, 6) % BUCKETS


# --- packed arrays -----------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as byte planes, each in the smallest width that holds it, compressed together."""
    parts = [len(arrays).to_bytes(1, "little")]
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
        a = np.ascontiguousarray(a, kind)
        width = a.dtype.itemsize
        parts += [width.to_bytes(1, "little"), len(a).to_bytes(8, "little"), a.view(np.uint8).reshape(-1, width).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 1
    for _ in range(data[0]):
        width, n = data[at], int.from_bytes(data[at + 1:at + 9], "little")
        at += 9
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel())
        at += n * width
    return out


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


# --- tokens to packed runs ---------------------------------------------------------------------

_ROWS = "flush bigint, part int, words binary, train binary, places binary, docs array<struct<id:{kind},tokens:bigint>>"


def _flush(texts: list[np.ndarray], vocabulary: list[bytes], held: np.ndarray, groups: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(word group, words and contexts, training counts, documents) of some texts' tokens.

    A text is its words' numbers in the vocabulary, then the end's, which is 0.
    """
    lengths = np.array([len(t) for t in texts])
    token = np.concatenate(texts).astype(np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64, len(vocabulary))
    contexts = np.fromiter(map(context_of, vocabulary), np.int64, len(vocabulary))
    before = np.concatenate([[0], token[:-1]])  # a text begins after an end
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    bits = max(1, (len(texts) - 1).bit_length())
    key = np.sort((rank[token] * LEAVES + contexts[before]) << bits | segments(lengths))
    at = _runs(key)
    times = np.diff(np.append(at, len(key)))
    key = key[at]
    doc, kind = key & ((1 << bits) - 1), key >> bits
    first = _runs(kind)
    train = np.add.reduceat(np.where(held[doc], 0, times), first)
    docs_of = np.diff(np.append(first, len(kind)))
    kind = kind[first]
    word = kind // LEAVES
    group = _group(hashes[order][word], groups)
    edges = np.searchsorted(group, np.arange(groups + 1))
    pairs = np.concatenate([[0], np.cumsum(docs_of)])
    for g in range(groups):
        a, b = int(edges[g]), int(edges[g + 1])
        if a < b:
            own = _runs(word[a:b])
            h = hashes[order][word[a:b][own]]
            yield (g, pack(np.diff(h, prepend=np.uint64(0)), np.diff(np.append(own, b - a)), kind[a:b] % LEAVES), pack(train[a:b]),
                   pack(docs_of[a:b], doc[pairs[a]:pairs[b]], times[pairs[a]:pairs[b]]))


def _group(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Word groups are ranges of the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _kinds(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, each kind's word, each kind's context) of a packed run."""
    steps, kinds, context = unpack(words)
    return np.cumsum(steps.astype(np.uint64), dtype=np.uint64), segments(kinds.astype(np.int64)), context.astype(np.int64)


def pack_tokens(docs: DataFrame, held_out: Column, path: str, id_column: str, text_column: str, groups: int, flush_tokens: int) -> None:
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"), held_out.alias("held"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        texts, ids, held, size, codes = [], [], [], 0, {b"": 0}  # the empty word is the end

        def emit() -> Iterator[pa.RecordBatch]:
            flush = (task << 24) + number
            rows = [{"flush": flush, "part": -1, "docs": [{"id": i, "tokens": len(t)} for i, t in zip(ids, texts)]}]
            rows += [{"flush": flush, "part": g, "words": w, "train": c, "places": p} for g, w, c, p in _flush(texts, list(codes), np.array(held, bool), groups)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

        for batch, raw in slices(batches, "text"):
            for key, text, out in zip(batch.column(0).to_pylist(), raw, batch.column(2).to_pylist()):
                words = words_of(text)
                if size and size + len(words) >= flush_tokens:
                    yield from emit()
                    texts, ids, held, size, codes, number = [], [], [], 0, {b"": 0}, number + 1
                number_of = codes.setdefault
                texts.append(np.array([number_of(w, len(codes)) for w in words] + [0], np.uint32))
                ids.append(key)
                held.append(bool(out))
                size += len(words) + 1
        if texts:
            yield from emit()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(_ROWS.format(kind=kind)))
    narrow.mapInArrow(run, _ROWS.format(kind=kind)).write.option("compression", "uncompressed").parquet(path)


def count_kinds(packed: DataFrame, groups: int) -> DataFrame:
    """(part, counts): all training counts of a word group, one row for each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, words, train in zip(*(c.to_pylist() for c in batch.columns)):
                h, word, context = _kinds(words)
                (n,) = unpack(train)
                seen = n > 0
                held.setdefault(part, []).append((h[word[seen]], context[seen], n[seen].astype(np.int64)))
        for part, found in held.items():
            h, context, n = (np.concatenate(x) for x in zip(*found))
            found.clear()
            words, code = np.unique(h, return_inverse=True)
            key = code * LEAVES + context
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            at = _runs(key)
            total = np.add.reduceat(n, at) if len(at) else n
            key = key[at]
            word = key // LEAVES
            data = pack(np.diff(words, prepend=np.uint64(0)), np.bincount(word, minlength=len(words)), key % LEAVES, total)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "counts": pa.array([data], pa.binary())})

    return (packed.where("part >= 0").select("part", "words", "train").repartitionById(groups, "part")
            .mapInArrow(run, "part int, counts binary"))


# --- seating -----------------------------------------------------------------------------------


@dataclass
class Totals:
    """Customers and tables of every restaurant (leaves, then endings, then the root), discounts of the three levels, words."""

    customers: np.ndarray
    tables: np.ndarray
    discounts: tuple[float, float, float]
    words: int
    tokens: int


def restaurants() -> int:
    return LEAVES + ENDINGS + 1


@functools.lru_cache(maxsize=8)
def _log_partitions(discount: float, top: int) -> np.ndarray:
    """[n, t]: logarithm of the weights of all ways to seat n customers at t tables, by recursion over n."""
    out = np.full((top + 1, top + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(top + 1)
    with np.errstate(divide="ignore"):
        for n in range(top):
            out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.log(np.maximum(n - discount * t[1:], 0)) + out[n, 1:])
    return out


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps up."""
    y = z + 8.0
    steps = np.log(np.multiply.reduce([z + k for k in range(8)]))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - steps


def _draw_few(n: np.ndarray, fresh: np.ndarray, discount: float, top: int, rng: np.random.Generator) -> np.ndarray:
    """Tables of n <= top customers, drawn from the distribution itself."""
    table = _log_partitions(discount, top)
    out = np.empty(len(n), np.int64)
    order = np.argsort(n, kind="stable")
    log_new = np.log(fresh)
    for at in np.split(order, _runs(n[order])[1:]):
        k = int(n[at[0]])
        t = np.arange(1, k + 1)
        for i in range(0, len(at), max(1, CELLS // k)):
            own = at[i:i + max(1, CELLS // k)]
            weight = table[k, 1:k + 1] + log_new[own, None] * t
            weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            draw = rng.random(len(own)) * weight[:, -1]
            out[own] = np.minimum((weight <= draw[:, None]).sum(axis=1), k - 1) + 1
    return out


def _sweep_many(n: np.ndarray, fresh: np.ndarray, discount: float, tables: np.ndarray, rest: np.ndarray, passes: int,
                rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(tables, customers away from the first customer's table) after ``passes`` steps that each seat all customers anew.

    Without the condition that they sum up to n - g, the sizes of the tables beside the first customer's one (of g customers)
    are a Poisson number of independent draws, P(s) ~ (1 - discount)(2 - discount)...(s - 1 - discount) x^s / s!, for any x
    up to 1; what is left of the seating's weight is G(g - discount) / G(g) x^g.  A step draws TRIES such seatings and
    takes one of them, or the seating there was, by these weights (iterated sampling-importance-resampling), which
    leaves the exact distribution as it is.
    """
    low, high = np.log(1 / n), np.zeros(len(n))  # of r = 1 - x, which makes the sizes sum up to about n
    for _ in range(40):
        middle = (low + high) / 2
        over = fresh * -np.expm1(middle) * np.exp(middle * (discount - 1)) > n
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    log_x = np.log1p(-np.minimum(np.exp(high), 1 - 1e-12))
    tables, rest = tables.copy(), rest.copy()

    def log_weight(away: np.ndarray, at: slice) -> np.ndarray:
        own = np.maximum(n[at] - away, 1).astype(float)
        return np.where(away < n[at], _log_gamma(own - discount) - _log_gamma(own) + own * log_x[at], -np.inf)

    edges = np.flatnonzero(np.diff(np.cumsum(fresh / discount + 1) // CELLS)) + 1
    for begin, end in zip([0, *edges], [*edges, len(n)]):
        at = slice(begin, end)
        for _ in range(passes):
            total = log_weight(rest[at], at)
            for _ in range(TRIES):
                owner = np.repeat(np.arange(end - begin), rng.poisson(fresh[at] / discount))
                with np.errstate(divide="ignore"):
                    size = np.log(1 - rng.random(len(owner))) / np.log1p(-rng.beta(discount, 1 - discount, len(owner)))
                size = 1 + np.floor(np.minimum(np.nan_to_num(size, nan=0.0, posinf=1e15), 1e15))
                kept = rng.random(len(owner)) < np.exp(size * log_x[at][owner])
                others = np.bincount(owner[kept], minlength=end - begin)
                away = np.bincount(owner[kept], size[kept], end - begin)
                weight = log_weight(away, at)
                total = np.logaddexp(total, weight)
                taken = np.log(1 - rng.random(end - begin)) < weight - total
                tables[at] = np.where(taken, others + 1, tables[at])
                rest[at] = np.where(taken, away.astype(np.int64), rest[at])
    return tables, rest


def seat_from(customers: np.ndarray, fresh: np.ndarray, discount: float, passes: int, rng: np.random.Generator,
              tables: np.ndarray, rest: np.ndarray, few: int = FEW) -> tuple[np.ndarray, np.ndarray]:
    """(tables, customers away from the first one's table) of each (restaurant, word); ``fresh`` is its weight for a new table.

    A seating has the weight fresh^tables times (1 - discount)(2 - discount)...(size - 1 - discount) for each table,
    which is what Gibbs steps over single customers lead to.  Up to ``few`` customers the number of tables is drawn
    from that distribution itself.  More customers are seated anew, all of them, ``passes`` times, from the seats given.
    """
    out, away = np.minimum(customers, 1), np.zeros(len(customers), np.int64)
    some = np.flatnonzero((customers > 1) & (customers <= few))
    if len(some):
        out[some] = _draw_few(customers[some], fresh[some], discount, few, rng)
    many = np.flatnonzero(customers > few)
    if len(many):
        n, t, r = customers[many], tables[many], rest[many]
        fits = (r < n) & (t >= 1) & (r >= t - 1) & ((r > 0) == (t > 1))  # the numbers of customers may have changed since
        out[many], away[many] = _sweep_many(n, fresh[many], discount, np.where(fits, t, 1), np.where(fits, r, 0), passes, rng)
    return out, away


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, passes: int, rng: np.random.Generator, few: int = FEW) -> np.ndarray:
    """Tables of each (restaurant, word), sampled from one table each on."""
    return seat_from(customers, fresh, discount, passes, rng, np.minimum(customers, 1), np.zeros(len(customers), np.int64), few)[0]


@dataclass
class Group:
    """One word group: its kinds (word, leaf) with counts, sorted; and the (word, ending) pairs above them."""

    words: np.ndarray
    word: np.ndarray
    leaf: np.ndarray
    count: np.ndarray

    def __post_init__(self):
        ending = self.word * ENDINGS + self.leaf // BUCKETS
        self.first = _runs(ending)
        self.pair = ending[self.first]  # word * ENDINGS + ending
        self.top = _runs(self.pair // ENDINGS)
        self.total = np.add.reduceat(self.count, _runs(self.word)) if len(self.word) else self.count

    @classmethod
    def of(cls, counts: bytes) -> Group:
        steps, kinds, leaf, n = unpack(counts)
        return cls(np.cumsum(steps.astype(np.uint64), dtype=np.uint64), segments(kinds.astype(np.int64)), leaf.astype(np.int64), n.astype(np.int64))

    def initial(self) -> tuple[np.ndarray, ...]:
        """One table for everything: tables of the leaves, of the pairs, of the root, then the customers away from the first one's table."""
        tables = np.minimum(self.count, 1), np.ones(len(self.pair), np.int64), np.ones(len(self.top), np.int64)
        return *tables, *(np.zeros(len(t), np.int64) for t in tables)

    def sums(self, seats) -> np.ndarray:
        """Customers, then tables, of every restaurant."""
        leaf, pair, top = seats[:3]
        mid = self.pair % ENDINGS
        guests, higher = self.above(seats)
        out = [np.bincount(self.leaf, self.count, LEAVES), np.bincount(mid, guests, ENDINGS), [higher.sum()],
               np.bincount(self.leaf, leaf, LEAVES), np.bincount(mid, pair, ENDINGS), [top.sum()]]
        return np.concatenate(out).astype(np.int64)

    def above(self, seats) -> tuple[np.ndarray, np.ndarray]:
        """Customers of the endings and of the root: the tables below."""
        if not len(self.word):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.add.reduceat(seats[0], self.first), np.add.reduceat(seats[1], self.top)

    def probabilities(self, seats, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Predictive probabilities of the words at the root, of the pairs, of the kinds."""
        d0, d1, d2 = totals.discounts[2], totals.discounts[1], totals.discounts[0]
        guests, higher = self.above(seats)
        c, t = totals.customers, totals.tables
        root = np.maximum(higher - d0 * seats[2], 0) / (STRENGTH + c[-1]) + (STRENGTH + d0 * t[-1]) / (STRENGTH + c[-1]) / (totals.words + 1)
        at = LEAVES + self.pair % ENDINGS
        pair = np.maximum(guests - d1 * seats[1], 0) / (STRENGTH + c[at]) + back_off(totals, at, d1) * root[self.pair // ENDINGS]
        up = np.repeat(np.arange(len(self.pair)), np.diff(np.append(self.first, len(self.word))))
        kind = np.maximum(self.count - d2 * seats[0], 0) / (STRENGTH + c[self.leaf]) + back_off(totals, self.leaf, d2) * pair[up]
        return root, pair, kind

    def resample(self, seats, totals: Totals, rng: np.random.Generator, passes: int):
        """Seat all customers again, leaves first, given the other words' totals and from the seats they have."""
        if not len(self.word):
            return seats
        d2, d1, d0 = totals.discounts
        root, pair, _ = self.probabilities(seats, totals)
        t = totals.tables
        up = np.repeat(np.arange(len(self.pair)), np.diff(np.append(self.first, len(self.word))))
        leaf, leaf_rest = seat_from(self.count, (STRENGTH + d2 * t[self.leaf]) * pair[up], d2, passes, rng, seats[0], seats[3])
        guests = np.add.reduceat(leaf, self.first)
        mid, mid_rest = seat_from(guests, (STRENGTH + d1 * t[LEAVES + self.pair % ENDINGS]) * root[self.pair // ENDINGS], d1, passes, rng, seats[1], seats[4])
        higher = np.add.reduceat(mid, self.top)
        top, top_rest = seat_from(higher, np.full(len(higher), (STRENGTH + d0 * t[-1]) / (totals.words + 1)), d0, passes, rng, seats[2], seats[5])
        return leaf, mid, top, leaf_rest, mid_rest, top_rest


def back_off(totals: Totals, at: np.ndarray, discount: float) -> np.ndarray:
    return (STRENGTH + discount * totals.tables[at]) / (STRENGTH + totals.customers[at])


# --- the job -----------------------------------------------------------------------------------


def _discount(ones: int, twos: int) -> float:
    """The usual estimate from the numbers of things seen once and twice."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones else 0.5


def _vector(table: DataFrame) -> np.ndarray:
    """Sum of all rows' ``sums``: a few numbers for each restaurant, whatever the size of the corpus."""
    rows = table.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(len(rows), np.int64)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


def learn(counts: DataFrame, folder: str, rounds: int = ROUNDS, samples: int = SAMPLES, passes: int = PASSES) -> tuple[DataFrame, list[Totals]]:
    """(counts with the kept samples' seats, the samples' totals); every round is a job that writes below ``folder``."""
    spark = counts.sparkSession
    n = restaurants()

    def seated(table: DataFrame, name: str, work) -> DataFrame:
        """Write ``work(part, group, seats so far) -> (lists of seats, facts)`` of each word group."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, packed in zip(*(batch.column(c).to_pylist() for c in ("part", "counts", "seats"))):
                    group = Group.of(data)
                    arrays = [a.astype(np.int64) for a in unpack(packed)] if packed else []
                    found, facts = work(part, group, [tuple(arrays[i:i + 6]) for i in range(0, len(arrays), 6)])
                    sums = np.concatenate([*(group.sums(x) for x in found), np.array(facts, np.int64)])
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part], pa.int32()), "counts": pa.array([data], pa.binary()),
                        "seats": pa.array([pack(*(a for x in found for a in x))], pa.binary()), "sums": pa.array([sums], pa.list_(pa.int64()))})

        schema = "part int, counts binary, seats binary, sums array<bigint>"
        table.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def begin(part: int, group: Group, _: list) -> tuple[list, list]:
        guests = np.bincount(group.pair // ENDINGS, minlength=len(group.words))  # endings that a word follows
        spread = np.bincount(group.word, minlength=len(group.words))
        return [group.initial()], [len(group.words), group.count.sum(), (group.count == 1).sum(), (group.count == 2).sum(),
                                   (spread == 1).sum(), (spread == 2).sum(), (guests == 1).sum(), (guests == 2).sum()]

    def drawing(sent, number: int, keep: int):
        def draw(part: int, group: Group, seats: list) -> tuple[list, list]:
            found = [seats[-1]]
            for k in range(keep):
                found.append(group.resample(found[-1], sent.value, np.random.default_rng([part, number, k]), passes))
            return found[1:], []
        return draw

    table = seated(counts.withColumn("seats", F.lit(None).cast("binary")), "seats-0", begin)
    v = _vector(table)
    if not len(v):
        v = np.zeros(2 * n + 8, np.int64)
    facts = v[2 * n:].tolist()
    level = tuple(_discount(*facts[i:i + 2]) for i in (2, 4, 6))
    totals = lambda x: Totals(x[:n].astype(float), x[n:2 * n].astype(float), level, facts[0], facts[1])
    known = [totals(v)]
    for number in range(1, rounds + 1):
        keep = samples if number == rounds else 1
        table = seated(table, f"seats-{number}", drawing(spark.sparkContext.broadcast(known[-1]), number, keep))
        v = _vector(table)
        v = v.reshape(keep, 2 * n) if len(v) else np.zeros((keep, 2 * n), np.int64)
        known = [totals(x) for x in v]
    return table, known


class Scorer:
    """Averaged predictive probabilities of one word group's kinds."""

    def __init__(self, counts: bytes | None, seats: bytes | None, kept: list[Totals]):
        empty = [np.zeros(0, np.int64)] * 3
        self.group = Group.of(counts) if counts is not None else Group(np.zeros(0, np.uint64), *empty)
        self.kept = kept
        arrays = [a.astype(np.int64) for a in unpack(seats)] if seats is not None else empty * 2 * len(kept)
        self.tables = [self.group.probabilities(arrays[6 * i:6 * i + 3], t) for i, t in enumerate(kept)]
        self.key = self.group.word * LEAVES + self.group.leaf

    def __call__(self, hashes: np.ndarray, word: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training count of the word, probability of the word in the leaf) of each kind."""
        known = self.group
        at, found = _lookup(known.words, hashes)
        w, seen = at[word], found[word]
        count = np.where(seen, known.total[w] if len(known.words) else 0, 0)
        pair, pair_seen = _lookup(known.pair, w * ENDINGS + leaf // BUCKETS)
        kind, kind_seen = _lookup(self.key, w * LEAVES + leaf)
        pair_seen, kind_seen = pair_seen & seen, kind_seen & seen
        total = np.zeros(len(word))
        for (root, pairs, kinds), t in zip(self.tables, self.kept):
            d2, d1, d0 = t.discounts
            unseen = (STRENGTH + d0 * t.tables[-1]) / (STRENGTH + t.customers[-1]) / (t.words + 1)
            p = np.where(seen, root[w], unseen) if len(root) else np.full(len(word), unseen)
            p = back_off(t, LEAVES + leaf // BUCKETS, d1) * p
            p = np.where(pair_seen, pairs[pair], p) if len(pairs) else p
            p = back_off(t, leaf, d2) * p
            total += np.where(kind_seen, kinds[kind], p) if len(kinds) else p
        return count, total / len(self.tables)


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of values in sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def score_documents(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", group_bytes: int = GROUP_BYTES,
                    flush_tokens: int = FLUSH_TOKENS, rounds: int = ROUNDS, samples: int = SAMPLES, passes: int = PASSES) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every document; rows where ``held_out`` holds are not learned from.

    Scores are sums of log10 probabilities over a text's words and its end.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "pitman-yor")
    size = docs.agg(F.sum(F.octet_length(docs[text_column]))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    pack_tokens(docs, held_out, f"{folder}/tokens", id_column, text_column, groups, flush_tokens)
    packed = spark.read.parquet(f"{folder}/tokens")
    count_kinds(packed, groups).write.option("compression", "uncompressed").parquet(f"{folder}/counts")
    counts, kept = learn(spark.read.parquet(f"{folder}/counts"), folder, rounds, samples, passes)
    tokens, words = kept[0].tokens, kept[0].words

    # a word group much larger than the mean is scored in several tasks
    load = {r["part"]: r["n"] for r in packed.where("part >= 0").groupBy("part")
            .agg(F.sum(F.octet_length("words") + F.octet_length("places")).alias("n")).collect()}
    mean = sum(load.values()) / max(1, len(load))
    shares = {p: max(1, round(n / mean)) for p, n in load.items()}
    offset, total = {}, 0
    for p in sorted(shares):
        offset[p], total = total, total + shares[p]
    plan = spark.createDataFrame([(p, offset[p], shares[p]) for p in sorted(shares)] or [(-2, 0, 1)], "p int, base int, parts int")
    runs = (packed.where("part >= 0").join(F.broadcast(plan), packed["part"] == plan["p"])
            .select((F.col("base") + F.pmod(F.xxhash64("flush"), F.col("parts")).cast("int")).alias("task"), "part", "flush", "words", "places"))
    known = (counts.join(F.broadcast(plan), counts["part"] == plan["p"])
             .select(F.explode(F.sequence(F.col("base"), F.col("base") + F.col("parts") - 1)).alias("task"), "part",
                     F.lit(-1).cast("bigint").alias("flush"), F.col("counts").alias("words"), F.col("seats").alias("places")))
    sent = spark.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, scorer = None, None
        for batch in batches:
            for p, flush, data, places in zip(*(batch.column(n).to_pylist() for n in ("part", "flush", "words", "places"))):
                if flush < 0 or p != part:
                    scorer = None  # the last group's arrays go first
                    part, scorer = p, Scorer(*((data, places) if flush < 0 else (None, None)), sent.value)
                if flush < 0:
                    continue
                hashes, word, leaf = _kinds(data)
                docs_of, doc, times = unpack(places)
                count, chance = scorer(hashes, word, leaf)
                kind = segments(docs_of.astype(np.int64))
                doc, times = doc.astype(np.int64), times.astype(float)
                seen = np.bincount(doc, times * (count > 0)[kind])
                base = np.bincount(doc, times * np.log10(count + 1.0)[kind])
                score = np.bincount(doc, times * np.log10(chance)[kind])
                some = np.flatnonzero(np.bincount(doc))
                yield pa.RecordBatch.from_pydict({"flush": pa.array([flush], pa.int64()), "sums": pa.array([zstandard.compress(
                    some.astype("<u4").tobytes() + seen[some].astype("<u4").tobytes() + base[some].astype("<f8").tobytes()
                    + score[some].astype("<f8").tobytes(), 1)], pa.binary())})

    sums = (known.unionByName(runs).repartitionById(max(1, total), "task").sortWithinPartitions("part", "flush")
            .mapInArrow(run, "flush bigint, sums binary"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush, held = None, []

        def emit():
            data = [np.frombuffer(zstandard.decompress(x), np.uint8).reshape(24, -1) for x in held]  # 24 bytes a document
            doc = np.concatenate([x[:4].reshape(-1).view("<u4") for x in data])
            n = int(doc.max()) + 1
            known_, base, score = (np.bincount(doc, np.concatenate([x[a:b].reshape(-1).view(k) for x in data]).astype(float), n)
                                   for a, b, k in ((4, 8, "<u4"), (8, 16, "<f8"), (16, 24, "<f8")))
            return pa.RecordBatch.from_pydict({"flush": pa.array(np.full(n, flush, np.int64)), "place": pa.array(np.arange(n, dtype=np.int32)),
                                               "known": pa.array(known_.astype(np.int64)), "base": pa.array(base), "score": pa.array(score)})

        for batch in batches:
            for f, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if f != flush and held:
                    yield emit()
                    held = []
                flush = f
                held.append(data)
        if held:
            yield emit()

    per_doc = (sums.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "flush").sortWithinPartitions("flush")
               .mapInArrow(add, "flush bigint, place int, known bigint, base double, score double"))
    own = packed.where("part = -1").select(F.col("flush").alias("f"), F.posexplode("docs").alias("at", "doc"))
    norm = float(np.log10(tokens + words + 1))
    return own.join(per_doc, (F.col("f") == F.col("flush")) & (F.col("at") == F.col("place"))).select(
        F.col("doc.id").alias(id_column), F.col("doc.tokens").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("base") - F.col("doc.tokens") * F.lit(norm)).alias("base_score"), "score")
