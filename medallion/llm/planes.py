"""Token ids in a binary format of shuffled bit planes (operator 1).

Documents are range-partitioned by id and encoded in ascending order; every
partition is one shard.  A shard's ids are cut into chunks of a fixed number of
ids.  A chunk is transposed into planes (plane k holds bit, or byte, k of every
id), each plane is compressed with zstandard by itself, and the payload starts
with the planes' index, so that a plane can be read without the others:

    magic "BPL1" | plane bits u8 (1 or 8) | plane count u8 | reserved u16 |
    ids u32 | per plane: compressed length u32 | the planes one after another

A row of the chunk table is one chunk: its place (shard, chunk, first id), the
payload, and its own part of the document index (which documents have ids in it,
up to where).  The table is written by Spark's Parquet writer, so a lost task is
repeated without leaving half a shard, and any store that Spark reaches will do.

Chunks are read back independently.  A document that spans chunks is put together
from the CRCs of its parts (crc32 of a concatenation follows from its parts' CRCs
and lengths), so no task ever needs more than one chunk.

Defined results: a null text is the empty one and has the end id alone.  Documents
with equal ids (repeated rows) are different documents, told apart by their place;
among them the order is by a hash of the text.  Null ids come first.  An empty table has no chunks.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.bpe import MEMO_ENTRIES, Memo, byte_letters, read_spec
from medallion.llm.common import slices
from medallion.session import scratch_path

MAGIC = b"BPL1"
CHUNK_IDS = 1 << 16
END_ID = 0


def pack_planes(ids: np.ndarray, plane_bits: int = 8, level: int = 1) -> bytes:
    """One chunk's payload.  Planes above the highest bit used are not stored."""
    ids = np.ascontiguousarray(ids, "<u4")
    width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    octets = ids.view(np.uint8).reshape(-1, 4)
    if plane_bits == 8:
        planes = [octets[:, k].tobytes() for k in range((width + 7) // 8)]
    elif plane_bits == 1:
        bits = np.unpackbits(octets, axis=1, bitorder="little", count=32)[:, :width]
        planes = [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(width)]
    else:
        raise ValueError("plane_bits is 1 or 8")
    packer = zstandard.ZstdCompressor(level=level)
    stored = [packer.compress(p) for p in planes]
    head = MAGIC + struct.pack("<BBHI", plane_bits, len(stored), 0, len(ids)) + struct.pack(f"<{len(stored)}I", *map(len, stored))
    return head + b"".join(stored)


def unpack_planes(payload: bytes) -> np.ndarray:
    """The ids of a payload; one that is damaged is refused."""
    if payload[:4] != MAGIC:
        raise ValueError("not a chunk of bit planes")
    plane_bits, count, _, n = struct.unpack_from("<BBHI", payload, 4)
    lengths = struct.unpack_from(f"<{count}I", payload, 12)
    at = 12 + 4 * count
    if at + sum(lengths) != len(payload):
        raise ValueError("a chunk of bit planes has the wrong length")
    out = np.zeros((n, 4), np.uint8)
    unpacker = zstandard.ZstdDecompressor()
    if plane_bits == 8:
        for k, length in enumerate(lengths):
            out[:, k] = np.frombuffer(unpacker.decompress(payload[at:at + length]), np.uint8)
            at += length
        return out.view("<u4").ravel()
    bits = np.zeros((n, 32), np.uint8)
    for k, length in enumerate(lengths):
        bits[:, k] = np.unpackbits(np.frombuffer(unpacker.decompress(payload[at:at + length]), np.uint8), count=n, bitorder="little")
        at += length
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


# The pre-token pattern over bytes, right wherever all characters beyond ASCII are letters.
_ASCII_TOKEN = re.compile(rb"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z\x80-\xff]+| ?[0-9]+| ?[!-/:-@\[-`{-~\x00-\x08\x0e-\x1f\x7f]+"
                          rb"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


class _SpaceRun(Exception):
    """A piece ends in white space, so the cut after it is not certain."""


class LibraryEncoder:
    """Whole texts through the tokenizers library, each distinct pre-token of a text once.

    The pre-tokenizer ends a pre-token before every space that follows something other
    than white space, so such a text's ids are those of its pieces, and a piece's ids
    those of its pre-tokens, which the library's model encodes.  Texts in which a space
    follows white space are cut at fewer places; those that may hold a special token go
    to the library as they are.
    """

    _certain = re.compile(rb"(?<=[!-~])(?= )")
    _odd = regex.compile(r"[^\x00-\x7f\p{L}]")

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        pre = self._tokenizer.pre_tokenizer
        self._byte_level = self._tokenizer.normalizer is None and str(pre).startswith("ByteLevel(add_prefix_space=False")
        self._letter = {b: c for c, b in byte_letters().items()}
        self._id = [i.to_bytes(4, "little") for i in range(1 + max(self._tokenizer.get_vocab().values()))]
        self._tokenize = self._tokenizer.model.tokenize
        self._tokens = Memo(self._token)
        self._pieces = Memo(self._piece)
        self._after_space = Memo(self._spaced, 2 * MEMO_ENTRIES)

    def _token(self, token: bytes) -> bytes:
        word = token.decode("latin-1").translate(self._letter)
        return b"".join([self._id[t.id] for t in self._tokenize(word)])

    def _piece(self, piece: bytes) -> bytes:
        if piece.isascii() or not self._odd.search(piece.decode("utf-8")):
            tokens = _ASCII_TOKEN.findall(piece)
            return self._token(piece) if len(tokens) == 1 else b"".join([self._tokens[t] for t in tokens])
        words = self._tokenizer.pre_tokenizer.pre_tokenize_str(piece.decode("utf-8"))
        return b"".join([self._id[t.id] for w, _ in words for t in self._tokenize(w)])

    def _spaced(self, piece: bytes) -> bytes:
        if piece.isalpha():  # ASCII letters after a space are one pre-token
            return b"".join([self._id[t.id] for t in self._tokenize("Ġ" + piece.decode())])
        if not piece or piece[-1] <= 32 or piece[-1] >= 128 and piece.decode("utf-8")[-1].isspace():
            raise _SpaceRun
        return self._piece(b" " + piece)

    def encode(self, data: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not data:
            return b""
        if not self._byte_level or b"<|" in data:
            return np.array(self._tokenizer.encode(data.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = data.split(b" ")
        try:
            if not rest or first and not first.decode("utf-8")[-1].isspace():
                return self._pieces[first] + b"".join(map(self._after_space.__getitem__, rest))
        except _SpaceRun:
            pass
        return b"".join([self._pieces[p] for p in self._certain.split(data)])


@functools.lru_cache(maxsize=2)
def _encoder(spec: str) -> LibraryEncoder:
    return LibraryEncoder(spec)


CHUNKS = ("shard int, chunk int, first_id bigint, n_ids int, payload binary, "
          "docs array<struct<ordinal:bigint,doc:{kind},begin:int,end:int,last:boolean>>")


def write_planes(docs: DataFrame, path: str, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
                 chunk_ids: int = CHUNK_IDS, plane_bits: int = 8, shards: int | None = None) -> None:
    """Encode ``docs`` and write the chunk table to ``path`` (a new folder)."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = CHUNKS.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = _encoder(spec.value), TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")
        open_ids, index, held, chunk, ordinal = [], [], 0, 0, 0

        def emit(ids: np.ndarray) -> pa.RecordBatch:
            row = {"shard": shard, "chunk": chunk, "first_id": chunk * chunk_ids, "n_ids": len(ids),
                   "payload": pack_planes(ids, plane_bits), "docs": list(index)}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        arrow = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                           ("payload", pa.binary()), ("docs", pa.list_(pa.struct([
                               ("ordinal", pa.int64()), ("doc", arrow_kind), ("begin", pa.int32()),
                               ("end", pa.int32()), ("last", pa.bool_())])))])
        for batch, texts in slices(batches, "text"):
            for key, text in zip(batch.column(0).to_pylist(), texts):
                ids = np.frombuffer((own.encode(text) if text else b"") + end, "<u4")
                at = 0
                while at < len(ids):
                    take = min(chunk_ids - held, len(ids) - at)
                    open_ids.append(ids[at:at + take])
                    index.append({"ordinal": ordinal, "doc": key, "begin": held, "end": held + take, "last": at + take == len(ids)})
                    held, at = held + take, at + take
                    if held == chunk_ids:
                        yield emit(np.concatenate(open_ids))
                        open_ids, index, held, chunk = [], [], 0, chunk + 1
                ordinal += 1
        if held:
            yield emit(np.concatenate(open_ids))

    arrow_kind = _arrow_type(narrow)
    (narrow.repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
     .mapInArrow(run, schema).write.parquet(path))


def _arrow_type(narrow: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(narrow.schema["id"].dataType)


# crc32 of a concatenation: the first part's CRC is carried over the second part's
# length by a linear map, which is built by squaring (zlib's published method).
def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


@functools.cache
def _zeros(power: int) -> list[int]:
    """The map of 2**power zero bytes on a CRC."""
    if power == 0:
        one = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
        for _ in range(3):
            one = [_times(one, v) for v in one]
        return one
    half = _zeros(power - 1)
    return [_times(half, v) for v in half]


def crc32_joined(parts: list[tuple[int, int]]) -> int:
    """crc32 of parts laid end to end, from their (crc32, bytes)."""
    out = 0
    for crc, length in parts:
        power = 0
        while length:
            if length & 1:
                out = _times(_zeros(power), out)
            length >>= 1
            power += 1
        out ^= crc
    return out


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc, start, n_tokens, ids_crc32) of every document, from the chunk table alone."""
    chunks = spark.read.parquet(path)
    # One row per shard: the windows below see the number of shards, not of documents.
    bases = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select(
        "shard", (F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("base"))
    kind = chunks.schema["docs"].dataType.elementType["doc"].dataType.simpleString()
    parts = chunks.mapInArrow(_part_digests, f"shard int, ordinal bigint, doc {kind}, chunk int, first bigint, n int, crc bigint, whole boolean")
    single = parts.where("whole").select("shard", "doc", "first", F.col("n").cast("bigint").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    joined = F.udf(lambda p: crc32_joined([(x["crc"], 4 * x["n"]) for x in p]), "bigint")
    spanning = (parts.where("not whole").groupBy("shard", "ordinal")
                .agg(F.first("doc").alias("doc"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
                     joined(F.array_sort(F.collect_list(F.struct("chunk", "crc", "n")))).alias("ids_crc32"))
                .select("shard", "doc", "first", "n_tokens", "ids_crc32"))
    return single.unionByName(spanning).join(bases, "shard").select(
        "doc", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def _part_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("shard", "chunk", "first_id", "payload")}
            data = memoryview(unpack_planes(row["payload"]).tobytes())
            docs = batch.column("docs").slice(i, 1).flatten()
            begin, end, last, ordinal = (docs.field(n).to_numpy(zero_copy_only=False) for n in ("begin", "end", "last", "ordinal"))
            whole = last.astype(bool)
            if row["chunk"] > 0:
                whole[:1] = False  # the first of a later chunk may continue from the one before
            n = len(begin)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, row["shard"], np.int32)), pa.array(ordinal), docs.field("doc"),
                pa.array(np.full(n, row["chunk"], np.int32)), pa.array(row["first_id"] + begin.astype(np.int64)),
                pa.array((end - begin).astype(np.int32)),
                pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist())], pa.int64()),
                pa.array(whole)], names=["shard", "ordinal", "doc", "chunk", "first", "n", "crc", "whole"])


def encode_to_files(docs: DataFrame, tokenizer_path: str, **options) -> tuple[str, DataFrame]:
    """Write ``docs`` to a fresh folder of the shared scratch area and read it back: (folder, digests)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-planes")
    write_planes(docs, path, tokenizer_path, **options)
    return path, read_digests(spark, path)
