"""Phrase collocation mining (operator 11).

Counting goes in passes over the texts, each of which keeps only what can still be frequent:
words; word pairs of frequent words; then all longer phrases whose pairs are all
frequent.  No phrase is more frequent than its parts, so nothing with ``least`` occurrences or more
is ever left out.  "Frequent" is looked up in a bitmap of ``FILTER_BITS`` bits of 64-bit hashes,
so the broadcast has a fixed size.  A false hit only lets through a phrase that the exact counts
remove afterwards; a bitmap that fills up makes more to shuffle, never another result.

The counts of all orders are then kept as streams, without any hash table:

* in *prefix order* (by the words from the first on) a phrase comes right after its own
  beginnings, so one lockstep pass with a stack of at most ``longest`` counts gives it the counts of
  all its beginnings, and every beginning the news that an extension to the right covers it;
* in *suffix order* (by the words from the last back) the same pass gives the counts of all
  its endings, and the extensions to the left.

A stream is cut into runs of near equal size at keys from a sample of it.  A run that begins inside
a word's extensions gets copies of the few counted beginnings of its first key, so the
extensions of one word may be spread over any number of tasks.  The language is the first
element of every key; its own count is the number of all its words.

A longer phrase that covers a candidate anywhere also makes one of its immediate
extensions cover it (that one is at least as frequent as the longer one), so
immediate extensions decide.

Defined results: texts have A-Z lower-cased and are split into pieces at ``.,;:!?`` and line ends (U+000A
to U+000D), pieces into words at blanks and tabs; a null text is empty, a null language is ``und``;
repeated rows count each time; ids are not read, nor any further columns; scores are exact
whole numbers of any size; equal scores are ordered by count, then by the phrase's UTF-8 bytes;
languages without a candidate, empty texts and empty tables give no rows.  A text of any length is read
whole, in parts cut at ends of pieces.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import hash_share, texts_of
from medallion.session import scratch_path

LONGEST = 4
LEAST = 30
BEST = 2000
SCALE = 2_000_000
#: A candidate goes if a longer phrase has this many of its occurrences in a hundred.
COVERED = 80
UNKNOWN = "und"
FILTER_BITS = 1 << 26
#: Bytes of text counted together in a task.
FLUSH_BYTES = 8 << 20
#: Sampled keys for each run of a stream.
SAMPLED = 40

# A-Z to lower case, ends of pieces to "A" (which lower-cased text has not), tabs to blanks.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORDS = bytes(65 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = re.compile(b"[" + re.escape(_ENDS) + b"]")
_COUNTS = "lang string, phrase string, n bigint"


class Words:
    """Numbered words of some texts in a row; number 0 stands between two pieces."""

    def __init__(self, texts: list[bytes]):
        self.words = b"\n".join(texts).translate(_WORDS).replace(b"A", b" A ").split()
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        numbers[b"A"]
        self.ids = np.fromiter(map(numbers.__getitem__, self.words), np.int64, len(self.words))
        self.known = list(numbers)

    def phrases(self, at: np.ndarray, order: int) -> list[bytes]:
        words = self.words
        return [b" ".join(words[i:i + order]) for i in at.tolist()]


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """Of every word, as Spark's xxhash64(lang, word)."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second << np.uint64(1) | second >> np.uint64(63))


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes the bitmap holds (see ``_bitmap``)."""
    at = hashes & np.uint64(len(bitmap) * 64 - 1)
    return bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) == 1


def _count_words(lang: str, x: Words, known) -> Iterator[tuple[list[bytes], np.ndarray]]:
    n = np.bincount(x.ids, minlength=len(x.known))
    yield [b"", *x.known[1:]], np.concatenate([[n[1:].sum()], n[1:]])


def _pairs(hashes: np.ndarray, x: Words, words: np.ndarray) -> np.ndarray:
    """Places of pairs of frequent words."""
    frequent = _known(words, hashes)
    frequent[0] = False
    there = frequent[x.ids]
    return np.flatnonzero(there[:-1] & there[1:])


def _count_pairs(lang: str, x: Words, known) -> Iterator[tuple[list[bytes], np.ndarray]]:
    at = _pairs(_hashes(lang, x.known), x, known[0])
    pairs, n = np.unique(x.ids[at] * len(x.known) + x.ids[at + 1], return_counts=True)
    words = x.known
    yield [words[a] + b" " + words[b] for a, b in zip((pairs // len(words)).tolist(), (pairs % len(words)).tolist())], n


def _count_longer(longest: int):
    def run(lang: str, x: Words, known) -> Iterator[tuple[list[bytes], np.ndarray]]:
        hashes = _hashes(lang, x.known)
        at = _pairs(hashes, x, known[0])
        at = at[_known(known[1], _pair_hashes(hashes[x.ids[at]], hashes[x.ids[at + 1]]))]
        numbers = x.ids[at] * len(x.known) + x.ids[at + 1]
        pair = np.zeros(len(x.ids) + 1, bool)
        pair[at] = True
        for order in range(3, longest + 1):  # a phrase goes on where another frequent pair begins at its last word
            on = pair[at + order - 2]
            at, numbers = at[on], numbers[on]
            if not len(at):
                return
            _, numbers = np.unique(numbers, return_inverse=True)  # small again, so that the next product fits
            _, first, numbers, n = np.unique(numbers * len(x.known) + x.ids[at + order - 1], return_index=True, return_inverse=True, return_counts=True)
            yield x.phrases(at[first], order), n
    return run


def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """The text cut at ends of pieces into parts of about ``limit`` bytes."""
    start = 0
    while len(text) - start > limit and (end := _END.search(text, start + limit)):
        yield text[start:end.start()]
        start = end.end()
    yield text[start:]


def _counts(kernel, known, flush_bytes: int):
    """Phrases and their counts from each flush of a task's texts, one language at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, list[bytes]] = defaultdict(list)
        sizes: defaultdict[str, int] = defaultdict(int)
        maps = known.value if known is not None else None

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            x = Words(held.pop(lang))
            for phrases, n in kernel(lang, x, maps):
                text = pa.array(phrases, pa.binary()).view(pa.string())
                yield pa.record_batch([pa.array([lang] * len(phrases), pa.string()), text, pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                for part in _parts(text, flush_bytes):
                    held[lang].append(part)
                    sizes[lang] += len(part) + 1
                    if sizes[lang] >= flush_bytes:
                        yield from flush(lang)
                if sum(sizes.values()) >= 4 * flush_bytes:  # many languages
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)
    return run


def _bitmap(counted: DataFrame, bits: int) -> np.ndarray:
    """A bit at the hash of every counted word or pair; at most bits / 64 rows come to the driver."""
    words = F.split("phrase", " ")
    first, second = (F.xxhash64("lang", F.get(words, F.lit(i))) for i in range(2))
    turned = F.shiftleft(second, 1).bitwiseOR(F.shiftrightunsigned(second, 63))
    at = F.when(F.size(words) == 1, first).otherwise(first.bitwiseXOR(turned)).bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    rows = (counted.where(F.col("phrase") != "").select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_column: str = "text", lang_column: str = "lang",
                  filter_bits: int = FILTER_BITS, flush_bytes: int = FLUSH_BYTES) -> DataFrame:
    """(lang, phrase, n) of all phrases of 1 to ``longest`` words that occur ``least`` times or more; under the empty phrase, all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs[lang_column], F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    path, maps, passes = scratch_path(spark, "collocations"), [], [_count_words, _count_pairs, _count_longer(longest)][:longest]
    for number, kernel in enumerate(passes):
        known = spark.sparkContext.broadcast(maps) if maps else None
        counted = rows.mapInArrow(_counts(kernel, known, flush_bytes), _COUNTS)
        if number:  # a flush has each phrase once and few of them again in the next: nothing to sum before the shuffle
            counted = counted.repartition("lang", "phrase")
        (counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
         .where((F.col("n") >= least) | (F.col("phrase") == "")).write.parquet(f"{path}/{number}"))
        if known is not None:
            known.unpersist()
        if number + 1 < len(passes):
            maps = [*maps, _bitmap(spark.read.parquet(f"{path}/{number}"), filter_bits)]
    return spark.read.schema(_COUNTS).parquet(*(f"{path}/{number}" for number in range(len(passes))))


def _key(lang: str, phrase: str, backwards: bool) -> tuple[str, ...]:
    words = phrase.split(" ") if phrase else []
    return (lang, *(reversed(words) if backwards else words))


def _deal(bounds: list[tuple[str, ...]], backwards: bool):
    """Every row's run, and copies of counted beginnings for the runs whose first key goes on from them."""
    needed: defaultdict[tuple[str, ...], list[int]] = defaultdict(list)
    for run, bound in enumerate(bounds, 1):
        for k in range(1, len(bound)):
            needed[bound[:k]].append(run)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(lang, phrase, backwards) for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())]
            marks = batch.column("mark").to_pylist()
            at, runs, copied = list(range(len(keys))), [bisect_right(bounds, key) for key in keys], [False] * len(keys)
            for i, key in enumerate(keys):
                if not marks[i] and key in needed:
                    at += [i] * len(needed[key])
                    runs += needed[key]
                    copied += [True] * len(needed[key])
            out = batch.take(pa.array(at, pa.int64()))
            yield pa.record_batch([*out.columns, pa.array(runs, pa.int32()), pa.array(copied, pa.bool_())], names=[*batch.schema.names, "run", "copied"])
    return deal


def _streamed(rows: DataFrame, backwards: bool) -> DataFrame:
    """The stream in prefix (or suffix) order, in runs; a phrase's own row comes before marks on it."""
    spark = rows.sparkSession
    counted = rows.where(~F.col("mark"))
    runs = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLED * runs / max(counted.count(), 1))
    sample = sorted(_key(r["lang"], r["phrase"], backwards) for r in counted.where(hash_share(F.xxhash64("lang", "phrase")) <= share).select("lang", "phrase").collect())
    bounds = sorted({sample[len(sample) * i // runs] for i in range(1, runs)}) if sample else []
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    key = F.concat(F.array("lang"), F.reverse(words) if backwards else words)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", run int, copied boolean"
    return (rows.mapInArrow(_deal(bounds, backwards), schema).withColumn("key", key)
            .repartitionById(runs, F.col("run")).sortWithinPartitions("run", "key", "mark"))


def _walk(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[tuple]:
    """(counts of the key's beginnings and itself, copied, mark, lang, phrase, *extra) of every row in key order."""
    run, path, counts = None, [], []
    names = ["run", "key", "n", "copied", "mark", "lang", "phrase", *extra]
    for batch in batches:
        for at, key, n, copied, mark, *rest in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
            if at != run:
                run, path, counts = at, [], []
            if not mark:
                same = 0
                while same < len(path) and same < len(key) and path[same] == key[same]:
                    same += 1
                if same == len(key):  # the same key again: a copy beside its own row
                    same -= 1
                if same < len(key) - 1:
                    raise ValueError(f"the beginnings of {key} have not been counted")
                path, counts = key, [*counts[:same], n]
            yield counts, copied, mark, *rest


_HEADED = _COUNTS + ", heads array<bigint>, mark boolean"
_FOUND = "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score decimal(38,0), mark boolean"
#: Rows of one output batch.
_ROWS = 20_000


def _rows_out(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _forwards(covered: int):
    """Counts of beginnings for every phrase; marks on candidates that an extension to the right covers."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()), ("heads", pa.list_(pa.int64())), ("mark", pa.bool_())])

    def rows(batches):
        for counts, copied, _, lang, phrase in _walk(batches, []):
            if not copied:
                yield lang, phrase, counts[-1], counts[1:-1], False
                if len(counts) > 3 and 100 * counts[-1] >= covered * counts[-2]:
                    yield lang, phrase[:phrase.rindex(" ")], None, None, True

    return lambda batches: _rows_out(rows(batches), schema)


def _backwards(covered: int, scale: int):
    """Candidates that no extension to the right covers, with their lowest-scoring cut; marks on those that one to the left covers."""
    from decimal import Decimal

    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("l", pa.int64()), ("r", pa.int64()), ("n", pa.int64()),
                        ("score", pa.decimal128(38, 0)), ("mark", pa.bool_())])

    def rows(batches):
        waiting = None
        for counts, copied, mark, lang, phrase, heads in _walk(batches, ["heads"]):
            if copied:
                continue
            if mark:
                if waiting and waiting[:2] == (lang, phrase):
                    waiting = None
                continue
            if waiting:
                yield waiting
                waiting = None
            if len(counts) > 2:
                a, tails = counts[-1], counts[1:-1]  # tails: the counts of the last 1, 2, ... words
                score, _, left, right = min((scale * a // (l + r), k, l, r) for k, (l, r) in enumerate(zip(heads, reversed(tails))))
                waiting = (lang, phrase, a, left, right, counts[0], Decimal(score), False)
            if len(counts) > 3 and 100 * counts[-1] >= covered * counts[-2]:
                yield lang, phrase[phrase.index(" ") + 1:], None, None, None, None, None, True
        if waiting:
            yield waiting

    return lambda batches: _rows_out(rows(batches), schema)


def candidates(counted: DataFrame, covered: int = COVERED, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every counted phrase of two words and more that no longer one covers."""
    spark = counted.sparkSession
    path = scratch_path(spark, "collocation-streams")
    rows = counted.withColumn("mark", F.lit(False))
    _streamed(rows, False).mapInArrow(_forwards(covered), _HEADED).write.parquet(f"{path}/prefix")
    _streamed(spark.read.schema(_HEADED).parquet(f"{path}/prefix"), True).mapInArrow(_backwards(covered, scale), _FOUND).write.parquet(f"{path}/suffix")
    found = spark.read.schema(_FOUND).parquet(f"{path}/suffix")
    return found.where(~F.col("mark")).drop("mark").join(found.where("mark").select("lang", "phrase"), ["lang", "phrase"], "left_anti")


def best_of(found: DataFrame, best: int = BEST) -> DataFrame:
    """The first ``best`` of every language, ranked, with one global sort and sums over its partitions."""
    spark = found.sparkSession
    path = scratch_path(spark, "collocation-ranks")
    found.orderBy("lang", F.desc("score"), F.desc("a"), "phrase").withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("run", F.shiftright("at", 33))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each language in each partition of the sort
    parts = rows.groupBy(F.col("lang").alias("of"), F.col("run").alias("part")).agg(F.count("*").alias("size"), F.min("at").alias("first"))
    parts = parts.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).where(F.col("base") < best).drop("size")
    ranked = rows.join(parts, (rows["lang"] == parts["of"]) & (rows["run"] == parts["part"])).withColumn("rank", F.col("base") + F.col("at") - F.col("first") + 1)
    return ranked.where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, best: int = BEST, covered: int = COVERED,
                 text_column: str = "text", lang_column: str = "lang", **settings: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): every language's best phrases of 2 to ``longest`` words."""
    counted = phrase_counts(docs, longest, least, text_column, lang_column, **settings)
    return best_of(candidates(counted, covered), best)
