"""Similar names across two sources (R3, R4): an exact similarity join on q-grams.

Names that no rule brings together are proposed to each other when their sets of q-grams
have a Jaccard similarity of ``least`` percent or more.  No pair of names is looked at
unless it has rare q-grams in common:

* All q-grams are put in one order, rare ones first.  Two sets of sizes m and n can only reach the
  limit with o >= least (m + n) / (100 + least) common elements, so the first common one lies among
  the first size - ceil(least size / 100) + 1 of each (the prefix).  Joining on prefix elements finds every pair.
* The names of a q-gram are compared in blocks of at most about ``CHUNK`` by ``CHUNK``, each by itself, so that
  neither one task nor its memory depends on how common the q-gram is.  Within a block two names of
  given sizes are looked at only where the q-gram lies in both names' prefix for these two sizes, which is shorter, and
  the comparison is of bits: every name has a summary of ``WORDS * BITS`` bits, one set by each q-gram.  The bits two names have in
  common, and the fewer of the q-grams that share a bit with another of the same name, bound the common q-grams from above.
* A q-gram with more than ``largest`` pairs, of more than ``FEW`` names on both sides, is not compared.  Its names are dealt out by both sizes
  first: for given m and n the prefix is only size - o + 1 long, which most names' places of a common q-gram are
  beyond.  What is still large is dealt out by the second common element as well, which lies within a
  prefix one longer, then by the third.  So a q-gram that a third of all names share is split; groups that
  are large even then hold names alike in nearly all that the limit asks for, and are compared as they are.
* What the bits leave is a list of pairs of ids.  Each pair is counted exactly, once, from the q-grams themselves.

The order is by counts of ``BUCKETS`` hash classes of q-grams, a table of fixed size; any order gives
the same pairs.  Percentages are compared as whole numbers.  Keys carry ids and bits, not texts.  The q-grams and the pairs of
every round are written to the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.session import scratch_path

Q = 3
LEAST = 80
LARGEST = 100_000
BUCKETS = 1 << 16
#: Most elements of a key, and the names on either side from which a key is dealt out further.
DEPTH = 3
FEW = 1 << 15
#: Names on either side of a block, pairs of a block that are compared at a time, and the bits of a name's summary.
CHUNK = 1 << 13
STRIP = 1 << 17
WORDS, BITS = 4, 60


def q_grams(text: Column, q: int = Q) -> Column:
    """Distinct substrings of ``q`` characters; a shorter text is one element."""
    places = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (q - 1), F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(q))))


def _ordered(rows: DataFrame) -> DataFrame:
    """(side, text, tokens, size, id, w0, ...): every text's q-grams, rare ones first, and its bits."""
    grams = rows.select("side", "text", F.explode("grams").alias("gram")).withColumn("hash", F.xxhash64("gram")).withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("n"))  # BUCKETS rows at most
    bit = F.pmod(F.xxhash64("hash"), F.lit(WORDS * BITS)).cast("int")
    grams = grams.join(F.broadcast(counts), "bucket").select("side", "text", "n", "gram", bit.alias("bit"))
    words = [F.bit_or(F.expr(f"IF(bit div {BITS} = {i}, shiftleft(1L, bit % {BITS}), 0L)")).alias(f"w{i}") for i in range(WORDS)]
    ranked = grams.groupBy("side", "text").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("found"), *words)
    return ranked.select("side", "text", F.transform("found", lambda x: x["gram"]).alias("tokens"), F.size("found").alias("size"),
                         F.monotonically_increasing_id().alias("id"), *_words())


def _words() -> list[str]:
    return [f"w{i}" for i in range(WORDS)]


def _common(sizes: Column, least: int) -> Column:
    """The fewest common elements with which sets of these sizes together can reach the limit."""
    return F.ceil(sizes * least / F.lit(100 + least)).cast("int")


def _keyed(rows: DataFrame, found: Column) -> DataFrame:
    """One row for each of the new keys ``found`` (key, place, other), with the key as text."""
    sizes = F.when(F.col("side") == 0, F.concat_ws("\x01", "size", "x.other")).otherwise(F.concat_ws("\x01", "x.other", "size"))
    return (rows.select("side", "id", "size", *_words(), F.explode(found).alias("x"))
            .select("side", "id", "size", *_words(), "x.key", "x.place", "x.other",
                    F.concat_ws("\x00", F.array_join("x.key", "\x00"), F.when(F.col("x.other").isNotNull(), sizes)).alias("at")))


def _by_first(rows: DataFrame, least: int) -> DataFrame:
    """Keys of one prefix element, whatever the other name's size."""
    upto = F.col("size") - F.ceil(F.col("size") * least / F.lit(100)).cast("int") + 1
    return _keyed(rows, F.transform(F.sequence(F.lit(1), upto), lambda i: F.struct(
        F.array(F.get("tokens", i - 1)).alias("key"), i.alias("place"), F.lit(None).cast("int").alias("other"))))


def _by_sizes(rows: DataFrame, least: int) -> DataFrame:
    """The same keys for each size that the other name may have and with which the place lies in the prefix."""
    others = F.sequence(F.ceil(F.col("size") * least / F.lit(100)).cast("int"), F.floor(F.col("size") * 100 / F.lit(least)).cast("int"))
    within = F.filter(others, lambda n: F.col("place") <= F.col("size") - _common(F.col("size") + n, least) + 1)
    return _keyed(rows, F.transform(within, lambda n: F.struct(F.col("key"), F.col("place"), n.alias("other"))))


def _by_next(rows: DataFrame, least: int) -> DataFrame:
    """Keys longer by one of the elements that can be the next common one."""
    upto = F.least(F.col("size") - _common(F.col("size") + F.col("other"), least) + F.size("key") + 1, F.col("size"))
    places = F.when(F.col("place") < upto, F.sequence(F.col("place") + 1, upto)).otherwise(F.array().cast("array<int>"))
    return _keyed(rows, F.transform(places, lambda i: F.struct(F.concat("key", F.array(F.get("tokens", i - 1))).alias("key"), i.alias("place"), F.col("other"))))


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of one block after another; the rows are in the blocks' order."""
    held, last = [], None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)]):
            if held and b > a and blocks[a] != last:
                yield {c: np.concatenate([h.column(c).to_numpy() for h in held]) for c in batch.schema.names}
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
                last = blocks[a]
    if held:
        yield {c: np.concatenate([h.column(c).to_numpy() for h in held]) for c in held[0].schema.names}


def _sizes(size: np.ndarray, first: int, end: int) -> list[tuple[int, int, int]]:
    """(size, first row, row after the last) of every stretch of one size."""
    edges = first + 1 + np.flatnonzero(size[first + 1:end] != size[first:end - 1])
    return [(int(size[a]), a, b) for a, b in zip([first, *edges.tolist()], [*edges.tolist(), end])]


def _alike(block: dict[str, np.ndarray], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (left, right) of a block whose bits allow the similarity; the rows are ordered by side, size and place."""
    size, place, deep = block["size"], block["place"], int(block["depth"].max())
    words = [block[w].view(np.uint64) for w in _words()]
    spare = size - sum(np.bitwise_count(w).astype(np.int64) for w in words)  # q-grams that share a bit with another
    split = int(np.searchsorted(block["side"], 1))
    if not 0 < split < len(size):
        return
    rights = _sizes(size, split, len(size))
    for m, a, b in _sizes(size, 0, split):
        for n, c, d in rights:
            need = -(-(m + n) * least // (100 + least))
            if need > min(m, n):
                continue
            to_left = a + int(np.searchsorted(place[a:b], m - need + deep, "right"))
            to_right = c + int(np.searchsorted(place[c:d], n - need + deep, "right"))
            if to_left == a or to_right == c:
                continue
            enough = np.clip(need - np.minimum(spare[c:to_right], spare[a:to_left].max()), 0, 255).astype(np.uint8)
            step = max(1, STRIP // (to_right - c))
            for at in range(a, to_left, step):
                upto = min(at + step, to_left)
                shared = np.bitwise_count(words[0][at:upto, None] & words[0][None, c:to_right])
                for w in words[1:]:  # WORDS * BITS is below 256
                    shared += np.bitwise_count(w[at:upto, None] & w[None, c:to_right])
                i, j = np.nonzero(shared >= enough)
                both = shared[i, j] + np.minimum(spare[at + i], spare[c + j]) >= need
                yield at + i[both], c + j[both]


def _compare(least: int):
    """(left, right): ids of pairs that may be similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_blocks(batches):
            for i, j in _alike(block, least):
                if len(i):
                    yield pa.record_batch([pa.array(block["id"][i]), pa.array(block["id"][j])], names=["left", "right"])
    return run


def _blocks(keys: DataFrame) -> DataFrame:
    """The names of every key dealt to blocks: each on one side's part of its own, for every part of the other side."""
    own, other = (F.when(F.col("side") == 0, F.col(a)).otherwise(F.col(b)) for a, b in ("lr", "rl"))
    chunks = [F.ceil(c / F.lit(CHUNK)).cast("int") for c in (own, other)]
    mine, theirs = F.pmod(F.xxhash64("id"), chunks[0]).cast("int"), F.col("theirs")
    numbers = [F.when(F.col("side") == 0, a).otherwise(b) for a, b in ((F.col("mine"), theirs), (theirs, F.col("mine")))]
    names = ["side", "id", "size", "place", "depth", *_words()]
    blocks = (keys.select("at", "side", "id", "size", "place", F.size("key").alias("depth"), *_words(), mine.alias("mine"),
                          F.explode(F.sequence(F.lit(0), chunks[1] - 1)).alias("theirs"))
              .select(F.xxhash64("at", *numbers).alias("block"), *(F.col(c).cast("long") for c in names)))
    # a little data is a lot of work here: partitions by count, not by size
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(parts, "block").sortWithinPartitions("block", "side", "size", "place")


def _met(keys: DataFrame, least: int) -> DataFrame:
    """(left, right): ids of the pairs of one key whose bits allow the similarity; a pair may come from several keys."""
    return _blocks(keys).mapInArrow(_compare(least), "left bigint, right bigint")


def _counted(pairs: DataFrame, tokens: DataFrame, least: int) -> DataFrame:
    """Pairs of ids that are similar enough, with their texts, after an exact count."""
    left, right = (tokens.where(F.col("side") == i).select(F.col("id").alias(name), F.col("text").alias(f"{name}_text"), F.col("tokens").alias(f"{name}_tokens"))
                   for i, name in enumerate(("left", "right")))
    shared = F.size(F.array_intersect("left_tokens", "right_tokens"))
    sizes = F.size("left_tokens") + F.size("right_tokens")
    counted = pairs.join(left, "left").join(right, "right").select("left_text", "right_text", shared.alias("shared"), (sizes - shared).alias("all"))
    return (counted.where(F.col("shared") * 100 >= F.col("all") * least)
            .select(F.col("left_text").alias("left"), F.col("right_text").alias("right"), F.floor(F.col("shared") * 100 / F.col("all")).cast("int").alias("match_percent")))


def similar_pairs(left: DataFrame, right: DataFrame, least: int = LEAST, q: int = Q, largest: int = LARGEST) -> DataFrame:
    """(left, right, match_percent) of all pairs of distinct texts (column ``text``) at ``least`` percent or more; nulls match nothing."""
    if not 0 < least <= 100:
        raise ValueError("the limit is a percentage above 0")
    spark, path = left.sparkSession, scratch_path(left.sparkSession, "similar-pairs")
    sides = [d.select(F.lit(i).alias("side"), F.col("text")).where("text IS NOT NULL").distinct() for i, d in enumerate((left, right))]
    _ordered(sides[0].unionByName(sides[1]).withColumn("grams", q_grams(F.col("text"), q))).write.parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    rows, found = tokens, []
    for number, dealt in enumerate((_by_first, _by_sizes, *(_by_next,) * (DEPTH - 1))):
        keys = dealt(rows, least)
        # keys of one side are left out; large ones are told from those to be compared now
        count = keys.groupBy("at").agg(*(F.count_if(F.col("side") == i).alias(c) for i, c in enumerate("lr"))).where("l > 0 AND r > 0")
        large = (F.col("l") * F.col("r") > largest) & (F.least("l", "r") > FEW)
        count.withColumn("large", large).write.parquet(f"{path}/counts{number}")
        count = spark.read.parquet(f"{path}/counts{number}")
        live = keys.join(count, "at")
        # a key is not made longer than the elements that a pair of its sizes needs
        further = F.col("large") & F.lit(number < DEPTH)
        if number:
            further = further & (_common(F.col("size") + F.col("other"), least) > F.size("key"))
        _met(live.where(~further), least).write.parquet(f"{path}/pairs{number}")
        found.append(f"{path}/pairs{number}")
        if count.where("large").isEmpty():
            break
        # only keys that are made longer need the q-grams again
        (live.where(further).select("side", "id", "size", *_words(), "key", "place", "other")
         .join(tokens.select("id", "tokens"), "id").write.parquet(f"{path}/rows{number}"))
        rows = spark.read.parquet(f"{path}/rows{number}")
        if rows.isEmpty():
            break
    return _counted(spark.read.parquet(*found).distinct(), tokens, least)


def name_proposals(report: DataFrame, left_label: str, right_label: str, least: int = LEAST, best: int | None = None, **settings: int) -> DataFrame:
    """(left_name, right_name, match_percent): candidates for the names that reconciliation leaves on one side.

    ``report`` is the table of ``reconcile.reconciliation``.  Normalised names are compared and
    every spelling of them is proposed.  ``best`` keeps that many of the most similar
    for each left name, ties by the right name.  The result can be reviewed and used as an
    override table (``reconcile.apply_overrides``).
    """
    # the report is used four times: it is made once
    spark, path = report.sparkSession, scratch_path(report.sparkSession, "report")
    report.select("side", "name", "name_norm").write.parquet(path)
    report = spark.read.parquet(path)
    sides = [report.where(F.col("side") == label).select("name", F.col("name_norm").alias("text")) for label in (left_label, right_label)]
    pairs = similar_pairs(*sides, least=least, **settings)
    named = (pairs.join(sides[0].select(F.col("name").alias("left_name"), F.col("text").alias("left")), "left")
             .join(sides[1].select(F.col("name").alias("right_name"), F.col("text").alias("right")), "right")
             .select("left_name", "right_name", "match_percent"))
    if best is None:
        return named
    order = Window.partitionBy("left_name").orderBy(F.desc("match_percent"), "right_name")
    return named.withColumn("place", F.row_number().over(order)).where(F.col("place") <= best).drop("place")
