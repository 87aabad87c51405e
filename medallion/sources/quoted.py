"""Delimited text whose quoted values hold line breaks (S1-S4), read in splits.

A line end inside quotes is no record end, and whether a place is inside quotes depends on all
that comes before it in the file.  Spark's own multi-line reader therefore reads every file
in one task.  Here a file stays splittable:

1. *Look.*  Every split of a file reads its lines once and finds out what it does to the
   quoting state: where it ends when it begins outside quotes, and where when it begins inside.  That is
   a function on two states; the usual line without a quote leaves both as they are.
2. *Compose.*  One row for each split.  A window over each file's splits composes the
   functions before it: the last split that ends the same way from either state decides, and
   the splits after it that swap the states are counted.
3. *Cut.*  The splits are read again, now with a known state.  Complete records are emitted as
   they are.  A record over the end of its split leaves a piece in each split it touches (two
   pieces for a split at most), and the pieces are put together by file and running number.

A quote opens a value only at the start of a field, as in the one-line reader, so a stray quote
inside an unquoted value (``5" disk``) changes nothing.  Between quotes a doubled quote stands for one.

Both readings have to see the same splits, so they run in a session of their own in which the
split size depends on nothing but ``split_bytes``; a split that the first reading has not seen
is an error.  How many tasks and files there are does not depend on it: a task reads neighbouring splits up to ``TASK_BYTES``.  The records are written to the shared scratch folder, so later stages and
lost executors do not read the files again.  What is broadcast is 17 bytes for each split
(128 MB of input).

Defined results: records end at ``\\n`` or ``\\r\\n``; line breaks inside values stay as they
are; blank lines between records are skipped; the first record of a file is its header, which
may hold line breaks too; a value that is never closed keeps its text as a malformed line to the end of the
file, and fails beyond ``max_record_bytes``, since it would swallow whatever follows; empty files
give nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.session import scratch_path

SPLIT_BYTES = 128 << 20
#: Input of one task: a task takes as many splits, one after another, as this holds.
TASK_BYTES = 32 << 20
MAX_RECORD_BYTES = 64 << 20
_BOM = b"\xef\xbb\xbf"
#: A record of nothing else is a blank line.
_BLANK = b" \t\r"

#: How a piece of text lies to its split: a whole record, one that goes on in the next split,
#: the end of one from before, or the whole split inside one.
WHOLE, OPENS, CLOSES, INSIDE = 0, 1, 2, 3


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether the line's end is inside quotes; linear in its length."""
    opening, at = sep + b'"', 0
    if not inside:
        if line.startswith(b'"'):
            at = 1
        else:
            at = line.find(opening)
            if at < 0:
                return False
            at += len(opening)
    while True:  # inside quotes at ``at``
        at = line.find(b'"', at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == b'"':
            at += 2
            continue
        at = line.find(opening, at + 1)
        if at < 0:
            return False
        at += len(opening)


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(path, start, first row, row after the last) of every stretch of a batch that comes from one split."""
    paths, starts = batch.column("path"), batch.column("start").to_numpy()
    if not len(starts):
        return
    change = np.flatnonzero((starts[1:] != starts[:-1]) | pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)) + 1
    edges = [0, *change.tolist(), len(starts)]
    for a, b in zip(edges, edges[1:]):
        yield paths[a].as_py(), int(starts[a]), a, b


def _quoted(lines: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _first(line: bytes, start: int, number: int) -> bytes:
    return line[len(_BOM):] if start == 0 and number == 0 and line.startswith(_BOM) else line


def _look(sep: bytes):
    """(path, start, from outside, from inside): what each split does to the quoting state."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = [], 0
        for batch in batches:
            for path, start, a, b in _splits(batch):
                if not out or out[-1][:2] != [path, start]:
                    out.append([path, start, False, True])
                    number = 0
                state, lines = out[-1], batch.column("line").slice(a, b - a)
                for i in _quoted(lines).tolist():
                    line, agreed = _first(lines[i].as_py(), start, number + i), state[2] == state[3]
                    state[2] = ends_inside(line, state[2], sep)
                    state[3] = state[2] if agreed else ends_inside(line, state[3], sep)
                number += b - a
        cols = list(zip(*out)) or [()] * 4
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=["path", "start", "outside", "inside"])
    return run


def split_states(looked: DataFrame) -> DataFrame:
    """(path, start, state) of every split: whether it begins inside quotes."""
    same, swap = F.col("outside") == F.col("inside"), F.col("outside") & ~F.col("inside")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = looked.withColumn("swaps", F.sum(swap.cast("long")).over(upto))
    decided = F.when(same, F.struct(F.col("outside").cast("long").alias("end"), F.col("swaps").alias("swaps")))
    last = F.last(decided, ignorenulls=True).over(before)
    later = F.coalesce(F.last("swaps").over(before), F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
    return swaps.select("path", "start", ((F.coalesce(last["end"], F.lit(0)) + later) % 2 == 1).alias("state"))


def _name(path: str, start: int) -> bytes:
    return hashlib.md5(f"{path}:{start}".encode(), usedforsecurity=False).digest()


class _Cutter:
    """Pieces of one split after another, from its lines in order."""

    def __init__(self, sep: bytes, limit: int):
        self.sep, self.limit, self.split, self.out = sep, limit, None, []

    def begin(self, path: str, start: int, inside: bool) -> None:
        self.end()
        self.split, self.number, self.header = (path, start), 0, start == 0
        self.inside = self.from_before = inside
        self.held, self.size = [], 0

    def _hold(self, lines: list[bytes]) -> None:
        self.held += lines
        self.size += sum(map(len, lines)) + len(lines)
        if self.size > self.limit:
            raise ValueError(f"a quoted value is not closed within {self.limit} bytes: {self.split[0]}, in the split at byte {self.split[1]}")

    def _emit(self, kind: int) -> None:
        text = b"\n".join(self.held)
        header = self.header and not self.from_before and bool(text.strip(_BLANK))
        self.out.append((*self.split, text, kind, header))
        self.header = self.header and not header
        self.held, self.size, self.from_before = [], 0, False

    def lines(self, lines: pa.Array, plain: np.ndarray) -> None:
        """The split's next lines.  ``plain`` is set where a line is a whole record; all others are held."""
        at = 0
        for i in [*_quoted(lines).tolist(), len(lines)]:
            if self.inside:
                self._hold(lines.slice(at, i - at).to_pylist())
            else:
                while self.header and at < i:  # the first record that is not blank
                    self._hold([_first(lines[at].as_py(), self.split[1], self.number + at)])
                    self._emit(WHOLE)
                    at += 1
                plain[at:i] = True
            if i < len(lines):
                line = _first(lines[i].as_py(), self.split[1], self.number + i)
                self.inside = ends_inside(line, self.inside, self.sep)
                self._hold([line])
                if not self.inside:
                    self._emit(CLOSES if self.from_before else WHOLE)
            at = i + 1
        self.number += len(lines)

    def end(self) -> None:
        """The split is over: what is still held goes on in the next one."""
        if self.split and self.held:
            self._emit(INSIDE if self.from_before else OPENS)

    def taken(self) -> pa.RecordBatch:
        cols, self.out = list(zip(*self.out)) or [()] * 5, []
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.bool_()))], names=_PIECES)


_PIECES = ["path", "start", "line", "kind", "header"]


def _cut(sep: bytes, states, limit: int):
    """(path, start, line, kind, header): records, and the pieces of those over a split's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cutter = states.value, _Cutter(sep, limit)
        for batch in batches:
            plain = np.zeros(batch.num_rows, bool)
            for path, start, a, b in _splits(batch):
                if cutter.split != (path, start):
                    inside = known.get(_name(path, start))
                    if inside is None:
                        raise ValueError(f"{path} has changed since it was first read: no split began at byte {start}")
                    cutter.begin(path, start, inside)
                cutter.lines(batch.column("line").slice(a, b - a), plain[a:b])
            rest = batch.filter(pa.array(plain))
            yield pa.record_batch([*(rest.column(c) for c in _PIECES[:3]), pa.array(np.full(rest.num_rows, WHOLE, np.int32)), pa.array(np.zeros(rest.num_rows, bool))], names=_PIECES)
            yield cutter.taken()
        cutter.end()
        yield cutter.taken()
    return run


def _reading_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session whose text scans are split by ``split_bytes`` alone, not by cores or other settings."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def records(spark: SparkSession, folders: str | Sequence[str], sep: str, glob: str | None = None,
            split_bytes: int = SPLIT_BYTES, max_record_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """(path, header, closed, record) of every record below the folders, as undecoded bytes without its line end."""
    folders = [folders] if isinstance(folders, str) else list(folders)
    own, mark, scratch = _reading_session(spark, split_bytes), sep.encode(), scratch_path(spark, "quoted-records")
    reader = own.read.format("text").option("recursiveFileLookup", True).option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(folders).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                                        F.col("value").cast("binary").alias("line"))
    splits = lines.rdd.getNumPartitions()
    # small splits share a task, but every core has some
    lines = lines.coalesce(max(min(splits, 2 * spark.sparkContext.defaultParallelism), -(-splits * split_bytes // TASK_BYTES)))
    lines.mapInArrow(_look(mark), "path string, start bigint, outside boolean, inside boolean").write.parquet(f"{scratch}/splits")
    states = split_states(own.read.parquet(f"{scratch}/splits"))
    names = states.select(F.unhex(F.md5(F.concat_ws(":", "path", F.col("start").cast("string")))).alias("name"), "state").toArrow()
    known = own.sparkContext.broadcast(dict(zip(names["name"].to_pylist(), names["state"].to_pylist())))
    (lines.mapInArrow(_cut(mark, known, max_record_bytes), "path string, start bigint, line binary, kind int, header boolean")
     .write.partitionBy("kind").parquet(f"{scratch}/pieces"))
    known.unpersist()
    schema = "path string, start bigint, line binary, header boolean, kind int"
    pieces = spark.read.schema(schema).parquet(f"{scratch}/pieces")
    # of a split's pieces, the end of a record from before comes first and one that goes on comes last
    order = Window.partitionBy("path").orderBy("start", F.col("kind") == OPENS)
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("number", F.sum((F.col("kind") == OPENS).cast("int")).over(order))
    piece = F.struct("start", (F.col("kind") == OPENS).alias("opens"), F.col("line").cast("string").alias("line"))
    joined = parts.groupBy("path", "number").agg(F.sort_array(F.collect_list(piece)).alias("pieces"), F.bool_or("header").alias("header"),
                                                 F.bool_or(F.col("kind") == CLOSES).alias("closed"))
    text = F.array_join(F.transform("pieces", lambda p: p["line"]), "\n")
    ended = pieces.where(F.col("kind") == WHOLE).select("path", "header", F.lit(True).alias("closed"), F.col("line").cast("string").alias("record"))
    rows = ended.unionByName(joined.select("path", "header", "closed", text.alias("record")))
    record = F.when(F.expr("endswith(cast(record as binary), X'0D')"), F.expr("substring(cast(record as binary), 1, octet_length(record) - 1)")).otherwise(F.col("record").cast("binary"))
    return rows.select("path", "header", "closed", record.alias("record")).where(F.trim(F.col("record").cast("string"), F.lit(_BLANK.decode())) != "")
