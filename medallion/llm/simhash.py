"""SimHash near-duplicates by bit-sliced comparison (operator 4).

Fingerprints: XXH64 (seed 42) of every shingle of a text's words; a bit is one when
it is set in over half of the hashes.  Equal fingerprints are one node from then on,
so that a group of copies of any size is one row.

Candidates: 64 bits in r + 1 blocks; two fingerprints that differ in at most r bits
agree on a whole block, and again on one of r + 1 parts of the other bits.  Every
(block, part) is a table: (r + 1)^2 keys of 28 bits each for r = 3, exact, with no
cap.  A fingerprint goes to each of its buckets.

Comparison: a task lays its buckets' fingerprints end to end and stores bit k of all
of them in plane k, 64 fingerprints to a machine word, in an order in which "the one
d places further on" is the same bit of the word d places further on.  For every
distance d between places, 64 pairs at a time are compared plane by plane; their
distances are counted by carry-save adders in vertical counters, and words in which
every pair has passed the radius are left out of the remaining planes.

Buckets of more than ``SPLIT`` fingerprints are first split again by the same rule on
their remaining bits.  A bucket's links are contracted to trees where they are found,
so what a task emits is at most linear in its rows; the trees of all buckets are
joined to components.

Defined results: null and wordless texts have fingerprint zero and are linked like
any other; a text of fewer words than a shingle is one shingle; repeated rows are
nodes with the same fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import slices
from medallion.llm.components import components
from medallion.session import scratch_path

SEED = 42
SHINGLE = 3
RADIUS = 3
#: A bucket with more fingerprints is split again on its remaining bits.
SPLIT = 4096
#: Hashes unpacked to bits at a time (64 bytes each).
_UNPACK = 1 << 16
#: Machine words (64 pairs each) compared at a time.
_AT_ONCE = 1 << 13


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of everything but ASCII white space."""
    return text.lower().split() if text else []


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    if not words:
        return 0
    grams = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), "<u8", len(grams))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _UNPACK):
        octets = hashes[at:at + _UNPACK].view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(octets, axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit integer with the same bits."""
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            values = np.fromiter((fingerprint(words_of(t), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "fp": pa.array(values.view(np.int64))})

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, fp bigint")


# --- comparison inside a task ------------------------------------------------------------------


def _planes(values: np.ndarray, words: int) -> np.ndarray:
    """64 bit planes of ``words`` machine words; value number i is bit i // words of word i % words."""
    padded = np.zeros(64 * words, "<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(64, words, 8), axis=2, bitorder="little")  # place, word, plane
    return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").transpose(2, 1, 0)).view("<u8")[:, :, 0]


def _marks(flags: np.ndarray, words: int) -> np.ndarray:
    """Flags in the order of the planes: one bit each."""
    padded = np.zeros(64 * words, bool)
    padded[:len(flags)] = flags
    return np.ascontiguousarray(np.packbits(padded.reshape(64, words), axis=0, bitorder="little").T).view("<u8")[:, 0]


def close_pairs(planes: np.ndarray, ahead: np.ndarray, first: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Bits of the pairs that are wanted and differ in at most ``radius`` planes.

    Row s of ``wanted`` compares word w of ``planes`` with word first + s + w of
    ``ahead``.  The counters start so that they overflow at radius + 1; a word is
    abandoned when all its pairs have.
    """
    levels = radius.bit_length()
    out = np.zeros(wanted.size, "<u8")
    alive = np.flatnonzero(wanted)
    shift, here = np.divmod(alive, wanted.shape[1])
    there = shift + here + first
    over = ~wanted.ravel()[alive]
    start = (1 << levels) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(alive), full if start >> k & 1 else np.uint64(0)) for k in range(levels)]
    for k in range(64):
        carry = planes[k][here]
        carry ^= ahead[k][there]
        for counter in counters:
            passed = counter & carry
            counter ^= carry
            carry = passed
        over |= carry
        if k % 4 == 3 and k >= 7:
            going = over != full
            if np.count_nonzero(going) < 0.75 * len(going):
                alive, here, there, over, counters = alive[going], here[going], there[going], over[going], [c[going] for c in counters]
                if not len(alive):
                    break
    out[alive] = ~over
    return out.reshape(wanted.shape)


def _merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (each the smallest place in it) after linking places a and b."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = np.arange(len(labels))
        low = np.minimum(x, y)
        np.minimum.at(parent, x, low)
        np.minimum.at(parent, y, low)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
        labels = parent[labels]


def link_buckets(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of distinct values laid end to end: (places, smallest place of their component), for linked places."""
    places, roots = [], []
    starts = np.cumsum(sizes) - sizes
    grade = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for g in np.unique(grade[sizes > 1]):
        chosen = np.flatnonzero((grade == g) & (sizes > 1))
        n = sizes[chosen]
        at = np.repeat(starts[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        left = np.repeat(n, n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))  # places left in the bucket, itself too
        own = values[at]
        most = int(n.max()) - 1
        words = -(-len(own) // 64)
        planes = _planes(own, words)
        labels = np.arange(len(own))
        d = 1
        while d <= most:
            whole, part = divmod(d, words)  # d places on: ``whole`` bits on, and ``part`` words
            ahead = planes >> np.uint64(whole)
            ahead = np.concatenate([ahead, ahead >> np.uint64(1)], axis=1)
            while d <= most and d // words == whole:
                n = min(max(1, _AT_ONCE // words), words - part, most + 1 - d)
                found = close_pairs(planes, ahead, part, np.stack([_marks(left > d + s, words) for s in range(n)]), radius)
                shift, word = np.nonzero(found)
                if len(word):
                    bits = np.unpackbits(found[shift, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    row, bit = np.nonzero(bits)
                    i = bit * words + word[row]
                    labels = _merge_labels(labels, i, i + d + shift[row])
                d, part = d + n, part + n
        linked = labels != np.arange(len(own))
        places.append(at[linked])
        roots.append(at[labels[linked]])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(roots)


def _bits_at(values: np.ndarray, positions: list[int]) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for i, p in enumerate(positions):
        out |= (values >> np.uint64(p) & np.uint64(1)) << np.uint64(i)
    return out


def links_of(values: np.ndarray, keys: np.ndarray, rest: list[list[int]], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between values with the same key (keys sorted), as trees: (place, place of its root).

    ``rest[t]`` are the bit positions that table ``t`` = key >> 32 has not fixed.
    """
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    starts, sizes = edge[:-1], np.diff(edge)
    small = sizes <= SPLIT
    take = np.repeat(small, sizes)
    place = np.flatnonzero(take)
    a, b = link_buckets(values[take], sizes[small], radius)
    out = [(place[a], place[b])]
    for s, n in zip(starts[~small].tolist(), sizes[~small].tolist()):
        positions = rest[int(keys[s]) >> 32]
        a, b = _link_large(values[s:s + n], positions, radius)
        out.append((a + s, b + s))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _link_large(values: np.ndarray, positions: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """One bucket, split once more: values that are close agree on one of radius + 1 parts of the open bits."""
    if len(values) <= SPLIT or len(positions) < 2 * (radius + 1):
        return link_buckets(values, np.array([len(values)]), radius)
    found = []
    for part in range(radius + 1):
        fixed = positions[part::radius + 1]
        open_ = [p for p in positions if p not in fixed]
        sub = _bits_at(values, fixed)
        order = np.argsort(sub, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], sub[order][1:] != sub[order][:-1], [True]]))
        sizes = np.diff(edge)
        small = np.repeat(sizes <= SPLIT, sizes)
        a, b = link_buckets(values[order[small]], sizes[sizes <= SPLIT], radius)
        found.append((order[small][a], order[small][b]))
        for s, n in zip(edge[:-1][sizes > SPLIT].tolist(), sizes[sizes > SPLIT].tolist()):
            a, b = _link_large(values[order[s:s + n]], open_, radius)
            found.append((order[s:s + n][a], order[s:s + n][b]))
    labels = _merge_labels(np.arange(len(values)), np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))
    linked = np.flatnonzero(labels != np.arange(len(values)))
    return linked, labels[linked]


# --- the job -----------------------------------------------------------------------------------


def _tables(radius: int) -> list[tuple[list[int], list[int]]]:
    """(bit positions of the block, of the part) for every table."""
    blocks = [list(map(int, x)) for x in np.array_split(np.arange(64), radius + 1)]
    out = []
    for block in blocks:
        others = [p for p in range(64) if p not in block]
        out += [(block, list(map(int, part))) for part in np.array_split(others, radius + 1)]
    return out


def _key(fp: Column, number: int, positions: tuple[list[int], list[int]]) -> Column:
    """The bucket key of one table: its number, then the bits at the positions (runs of neighbours at a time)."""
    out, filled = F.lit(number << 32).cast("bigint"), 0
    for group in positions:
        runs = np.split(group, np.flatnonzero(np.diff(group) != 1) + 1)
        for run in runs:
            piece = F.shiftrightunsigned(fp, int(run[0])).bitwiseAND(F.lit((1 << len(run)) - 1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(piece, filled))
            filled += len(run)
    return out


def linked_fingerprints(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): trees of links between the distinct fingerprints in ``nodes(fp)``."""
    tables = _tables(radius)
    rest = [[p for p in range(64) if p not in block and p not in part] for block, part in tables]
    keyed = nodes.select("fp", F.explode(F.array(*(_key(F.col("fp"), t, p) for t, p in enumerate(tables)))).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_v, held_k = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for last, batch in _with_last(batches):
            values = np.concatenate([held_v, batch.column("fp").to_numpy().view(np.uint64)]) if batch is not None else held_v
            keys = np.concatenate([held_k, batch.column("key").to_numpy()]) if batch is not None else held_k
            if last:
                cut = len(keys)
            else:  # the last bucket may go on in the next batch
                cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            held_v, held_k = values[cut:], keys[cut:]
            if cut:
                a, b = links_of(values[:cut], keys[:cut], rest, radius)
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(values[a].view(np.int64)), "b": pa.array(values[b].view(np.int64))})

    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(count, "key").sortWithinPartitions("key", "fp").mapInArrow(run, "a bigint, b bigint")


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id): component_id is the smallest id reachable over links of at most ``radius`` bits."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "simhash")
    fingerprints(docs, id_column, text_column, shingle).write.parquet(f"{folder}/fingerprints")
    own = spark.read.parquet(f"{folder}/fingerprints")
    own.groupBy("fp").agg(F.min("id").alias("least")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    reach = components(linked_fingerprints(nodes, radius))
    groups = (reach.join(nodes, reach["node"] == nodes["fp"]).groupBy("root").agg(F.min("least").alias("component"))
              .withColumnRenamed("root", "top"))
    member = reach.join(groups, reach["root"] == groups["top"]).select("node", "component")
    # written, so that the join below has a plain shuffle on either side and a hot fingerprint can be split
    (nodes.join(member, nodes["fp"] == member["node"], "left")
     .select("fp", F.coalesce("component", "least").alias("component_id")).write.parquet(f"{folder}/classes"))
    classes = spark.read.parquet(f"{folder}/classes").withColumnRenamed("fp", "f")
    return own.join(classes, own["fp"] == classes["f"]).select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id.

    Rows that repeat an id are one document, of which one row stays; rows without an id all stay.
    """
    found = near_duplicates(docs, id_column, text_column, shingle, radius)
    gone = (found.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("__gone")).distinct())
    named = docs.where(docs[id_column].isNotNull())
    kept = named.join(gone, named[id_column] == gone["__gone"], "left_anti")
    repeated = (docs.groupBy(docs[id_column].alias("__id")).agg(F.count("*").alias("n")).where("n > 1 and __id is not null").select("__id"))
    if not repeated.isEmpty():  # else the rows need not be brought together by id
        again = kept.join(repeated, kept[id_column] == repeated["__id"], "left_semi").dropDuplicates([id_column])
        kept = kept.join(repeated, kept[id_column] == repeated["__id"], "left_anti").unionByName(again)
    return kept.unionByName(docs.where(docs[id_column].isNull()))
