"""Byte-level BPE with forced boundaries (operator 8).

A byte pair that occurs inside no vocabulary token can be joined by no merge, so
a cut between its two bytes is certain.  Texts are cut there, every fragment is
encoded by itself (and remembered, since fragments repeat), and the ids are laid
end to end.  A fragment's merges take n log n steps, whatever its length.  Two levels use the same table of pairs:

* a text is cut before each space whose pair with the byte before it is forced.
  The pre-tokenizer never ends a run of characters differently because of such a
  cut: no alternative of its pattern holds a space except at the start or in a run
  of white space, and inside a run BPE cannot join the two sides anyway;
* the pre-tokens of such a piece are cut at every forced pair, and the merges run
  on what is left.

Defined results: null is the empty text, which has no ids and decodes to the empty
text; ids that end inside a UTF-8 sequence decode with U+FFFD like the library; the
special tokens in the text get their ids.  Repeated rows are encoded each by itself.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from medallion.llm.common import slices

# Fixed value: the pre-token pattern of byte-level BPE tokenizers with
# use_regex; white space is written out as Unicode's White_Space property.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"

#: Fragments remembered per worker; the older half goes when it is full.
MEMO_ENTRIES = 300_000
#: Bytes from which a fragment or piece is not remembered, and from which a fragment is merged with a heap.
MEMO_BYTES = 1024
LONG = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    for i, b in enumerate(sorted(set(range(256)) - set(plain))):
        letters[chr(256 + i)] = b
    return letters


_IDS = [struct.Struct(f"<{n}I").pack for n in range(33)]


class Memo(dict):
    """A dictionary that computes missing values and holds at most two generations of ``limit`` entries."""

    def __init__(self, compute, limit: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        if isinstance(key, bytes) and len(key) > MEMO_BYTES:
            return self.compute(key)
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class ForcedBoundaryBPE:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        if model["model"]["type"] != "BPE" or model.get("normalizer") or (model.get("pre_tokenizer") or {}).get("type") != "ByteLevel" \
                or model["pre_tokenizer"].get("add_prefix_space") or model["model"].get("ignore_merges"):
            raise ValueError("a byte-level BPE tokenizer file without normalizer and prefix space is needed")
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.vocab = {raw(t): i for t, i in model["model"]["vocab"].items()}
        self.special = {t["content"].encode(): t["id"] for t in model["added_tokens"]}
        self.token_bytes = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.single = {t[0]: i for t, i in self.vocab.items() if len(t) == 1}
        self.ranks, self.merged = {}, []  # pair of ids -> rank; rank -> id of the two joined
        for pair in model["model"]["merges"]:
            left, right = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks.setdefault(self.vocab[left] << 32 | self.vocab[right], len(self.merged))
            self.merged.append(self.vocab[left + right])
        self.joined = np.zeros((256, 256), bool)  # pairs inside some token; all others are forced boundaries
        for token in self.vocab:
            if len(token) > 1:
                codes = np.frombuffer(token, np.uint8)
                self.joined[codes[:-1], codes[1:]] = True
        self._inside = self.joined.tobytes()
        soft = [b for b in range(256) if self.joined[b, 0x20]]
        group = b"[" + b"".join(re.escape(bytes([b])) for b in soft) + b"]" if soft else b"(?!)"
        self._soft_space = re.compile(group + b" ")
        self._cut = re.compile(b"(?<!" + group + b")(?= )" if soft else b"(?= )")
        self._specials = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or b"(?!)")
        self._pre = regex.compile(PRE_TOKEN)
        self._fragment = Memo(self._merge)
        self._piece = Memo(self.encode_piece)
        self._after_space = Memo(lambda piece: self.encode_piece(b" " + piece))

    def boundaries(self, data: bytes) -> list[int]:
        """The offsets of all certain cuts."""
        codes = np.frombuffer(data, np.uint8)
        return [] if len(codes) < 2 else (np.flatnonzero(~self.joined[codes[:-1], codes[1:]]) + 1).tolist()

    def _merge(self, fragment: bytes) -> bytes:
        """Ids of one fragment, as little-endian 32-bit integers: the lowest-ranked pair is joined until none is left."""
        if len(fragment) > LONG:
            return self._merge_long(fragment)
        single, get, none = self.single, self.ranks.get, len(self.merged)
        ids = [single[b] for b in fragment]
        scores = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while scores:
            best = min(scores)
            if best == none:
                break
            i = scores.index(best)
            ids[i] = self.merged[best]
            del ids[i + 1], scores[i]
            if i < len(scores):
                scores[i] = get(ids[i] << 32 | ids[i + 1], none)
            if i:
                scores[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
        return _IDS[len(ids)](*ids) if len(ids) < len(_IDS) else struct.pack(f"<{len(ids)}I", *ids)

    def _merge_long(self, fragment: bytes) -> bytes:
        """The same with a heap of pairs over a linked list: n log n in the fragment's length."""
        single, get, merged, n = self.single, self.ranks.get, self.merged, len(fragment)
        ids = [single[b] for b in fragment]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [rank << 40 | i for i, pair in enumerate(zip(ids, ids[1:])) if (rank := get(pair[0] << 32 | pair[1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 40, entry & (1 << 40) - 1
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the two has been joined with another in the meantime
            ids[i], ids[j] = merged[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := get(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, rank << 40 | i)
            h = before[i]
            if h >= 0 and (rank := get(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(heap, rank << 40 | h)
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of a piece between text-level cuts: its pre-tokens, cut at every forced pair."""
        if piece[1:].isalpha() and (piece[:1] == b" " or piece[:1].isalpha()):
            tokens = (piece,)  # ASCII letters, after a space or not, are one pre-token
        else:
            tokens = [t.encode("utf-8") for t in self._pre.findall(piece.decode("utf-8"))]
        out, inside = [], self._inside
        for token in tokens:
            start = 0
            for i, (a, b) in enumerate(zip(token, token[1:]), 1):
                if not inside[a << 8 | b]:
                    out.append(self._fragment[token[start:i]])
                    start = i
            out.append(self._fragment[token[start:]])
        return b"".join(out)

    def pieces(self, data: bytes) -> list[bytes]:
        """The text cut before each space that a forced pair precedes."""
        return [p for p in self._cut.split(data) if p]

    def _plain(self, data: bytes) -> bytes:
        if not data:
            return b""
        if self._soft_space.search(data):
            return b"".join(map(self._piece.__getitem__, self.pieces(data)))
        first, *rest = data.split(b" ")
        return (self._piece[first] if first else b"") + b"".join(map(self._after_space.__getitem__, rest))

    def encode(self, data: bytes) -> bytes:
        """Ids of a whole text given as UTF-8, as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        for m in self._specials.finditer(data):
            out += [self._plain(data[at:m.start()]), self.special[m.group()].to_bytes(4, "little")]
            at = m.end()
        out.append(self._plain(data[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, as UTF-8; bytes that are none become U+FFFD.  Unknown ids stand for nothing."""
        data = b"".join(map(self.token_bytes.get, np.frombuffer(ids, "<u4").tolist(), _NOTHING))
        try:
            data.decode("utf-8")
        except UnicodeDecodeError:
            data = data.decode("utf-8", "replace").encode("utf-8")
        return data


class _Nothing:
    def __iter__(self):
        return self

    def __next__(self):
        return b""


_NOTHING = _Nothing()


@functools.lru_cache(maxsize=2)
def coder(spec: str) -> ForcedBoundaryBPE:
    """One coder per worker process and tokenizer, so that its memory of fragments serves all tasks."""
    return ForcedBoundaryBPE(spec)


def read_spec(path: str) -> str:
    """The tokenizer file's text, read once on the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): every text's ids as little-endian unsigned 32-bit integers in a binary column."""
    def kernel(coder_, batch, texts):
        ids = [coder_.encode(t) if t else b"" for t in texts]
        return {"ids": pa.array(ids, pa.binary())}

    return _per_text(docs, tokenizer_path, id_column, text_column, kernel, "ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded again."""
    def kernel(coder_, batch, texts):
        n, hashes, decoded = [], [], []
        for t in texts:
            ids = coder_.encode(t) if t else b""
            n.append(len(ids) // 4)
            hashes.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(coder_.decode(ids)).hexdigest())
        return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(hashes, pa.string()),
                "decoded_sha256": pa.array(decoded, pa.string())}

    return _per_text(docs, tokenizer_path, id_column, text_column, kernel,
                     "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _per_text(docs: DataFrame, tokenizer_path: str, id_column: str, text_column: str, kernel, schema: str) -> DataFrame:
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(spec.value)
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), **kernel(own, batch, texts)})

    return narrow.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_column)
