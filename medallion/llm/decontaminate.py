"""Benchmark decontamination with a generalised suffix automaton (operator 2).

The words of all benchmark items go into one suffix automaton.  A document's words
are streamed through it; after each word the automaton's state and length give the
longest run of words, ending there, that some item contains.  A run of at least
``window`` words lies in windows of items, word by word; an item shorter than the
window counts when all of it occurs.  Words that no item has send the automaton back
to its root, so only runs of known words are streamed at all.

The items are a stated query set.  They are read in blocks of at most
``block_bytes`` of text, chosen by a hash; one automaton (and one pass over the
documents) is made for each block, so its size does not follow the benchmark.  Only the
removal of spans holds the automata of all blocks at once (some 100 bytes for each item
word), since a cut can bring words of any item together.

Defined results: null and empty texts, and texts without a word, have no words and no
hits; items without a word have no window; items with equal ids are one item, an item
with a null id marks words but is not listed; no items at all mean no hits.  Repeated
documents are judged each by itself.  Very long texts are streamed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import slices

WINDOW = 10
BLOCK_BYTES = 1 << 18

# Words are runs of digits, letters a-z (A-Z count as these) and everything from
# U+0080 on; the byte table sends the rest to the space, on which bytes.split() cuts.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD_AT = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of items, each a list of words."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.length, self.link, self._next = [0], [-1], [{}]
        kept = []
        for name, words in items:
            if words:
                codes = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                kept.append((name, codes))
                last = 0
                for c in codes:
                    last = self._extend(last, c)
        # the ancestor (or self) whose class holds the suffix of ``window`` words
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.window_state = [0] * len(self.length)
        for v in order:
            if self.length[v] >= window:
                up = self.link[v]
                self.window_state[v] = v if self.length[up] < window else self.window_state[up]
        self.items_at: dict[int, set] = {}
        own: dict[int, list] = {}
        for name, codes in kept:
            state = 0
            for i, c in enumerate(codes, 1):
                state = self._next[state][c]
                # walking a whole item never needs a suffix link: each prefix of it is in the automaton
                if i >= window:
                    self.items_at.setdefault(self.window_state[state], set()).add(name)
            if len(codes) < window:
                own.setdefault(state, []).append((len(codes), name))
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for v in order:
            found = own.get(v, []) + self.short.get(self.link[v], [])
            if found:
                self.short[v] = found
        self.shortest = min((min(len(c), window) for _, c in kept), default=0)
        size = max(1, len(self.vocab))
        self.moves = {v * size + c: t for v, out in enumerate(self._next) for c, t in out.items()}
        self._size = size
        self._next = None

    def _extend(self, last: int, c: int) -> int:
        """Append word ``c`` after state ``last``, which stands for a whole prefix of the current item."""
        nxt, link, length = self._next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = self._new(length[last] + 1, {})
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _new(self, length: int, out: dict) -> int:
        self.length.append(length)
        self.link.append(0)
        self._next.append(out)
        return len(self.length) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self._next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self._next[p].get(c) == q:
            self._next[p][c] = clone
            p = self.link[p]
        return clone

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit intervals [begin, end) of words (they may overlap), and the items with an occurring window."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, items
        codes = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin >= self.shortest:
                self._stream(codes[begin:end].tolist(), begin, spans, items)
        return spans, items

    def _stream(self, codes: list[int], at: int, spans: list, items: set) -> None:
        moves, link, length, size, short, window = self.moves.get, self.link, self.length, self._size, self.short, self.window
        state = matched = 0
        for i, c in enumerate(codes, at + 1):
            target = moves(state * size + c)
            while target is None and state:
                state = link[state]
                matched = length[state]
                target = moves(state * size + c)
            if target is None:
                matched = 0
                continue
            state, matched = target, matched + 1
            if matched >= window:
                if spans and spans[-1][0] == i - matched:
                    spans[-1] = (i - matched, i)
                else:
                    spans.append((i - matched, i))
                items |= self.items_at[self.window_state[state]]
            if state in short:
                for words, name in short[state]:
                    if matched >= words:
                        spans.append((i - words, i))
                        items.add(name)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching intervals as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW,
             block_bytes: int = BLOCK_BYTES) -> Iterator[SuffixAutomaton]:
    """One automaton for each block of items; a block's text is bounded, whatever the number of items."""
    narrow = items.select(items[id_column].cast("string").alias("id"), items[text_column].alias("text")).where("text is not null")
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        rows = narrow.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        yield SuffixAutomaton(((r["id"], words_of(r["text"].encode())) for r in rows), window)


def match_documents(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    window: int = WINDOW, item_id: str = "item_id", item_text: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, spans, n_hit, items) of every document.

    ``spans`` are the hit words as merged intervals [begin, end) of word numbers;
    ``items`` the ids of the items with an occurring window, as sorted strings.
    """
    out = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"),
                      F.array().cast("array<struct<begin:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    spark = docs.sparkSession
    kind = out.schema["id"].dataType.simpleString()
    for automaton in automata(items, item_id, item_text, window, block_bytes):
        out = out.mapInArrow(_matcher(spark.sparkContext.broadcast(automaton)),
                             f"id {kind}, text string, n_words bigint, spans array<struct<begin:int,end:int>>, items array<string>")
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return out.select(F.col("id").alias(id_column), "n_words", "spans", hit.alias("n_hit"), "items")


def _matcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch, texts in slices(batches, "text"):
            n, spans, items = [], [], []
            before = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for text, old, names in zip(texts, *before):
                words = words_of(text)
                found, hit = automaton.matches(words)
                n.append(len(words))
                spans.append([{"begin": a, "end": b} for a, b in merged([(s["begin"], s["end"]) for s in old] + found)])
                items.append(sorted({*names, *hit} - {None}))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "text": batch.column("text"), "n_words": pa.array(n, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                "items": pa.array(items, pa.list_(pa.string()))})
    return run


def clean_text(text: bytes, automata_: list[SuffixAutomaton], min_words: int, max_coverage: float) -> bytes | None:
    """The text without its contaminated spans; None when they cover more than ``max_coverage`` of its words.

    A cut can bring two halves of a passage together, so the text is searched again until nothing is found.
    """
    first = True
    while True:
        words = words_of(text)
        spans = merged(s for a in automata_ for s in a.matches(words)[0])
        if first and spans and sum(b - a for a, b in spans) > max_coverage * len(words):
            return None
        first = False
        spans = [s for s in spans if s[1] - s[0] >= min_words]
        if not spans:
            return text
        at = [m.span() for m in _WORD_AT.finditer(text)]
        kept, last = [], 0
        for a, b in spans:
            kept.append(text[last:at[a][0]])
            last = at[b - 1][1]
        rest = kept + [text[last:]]
        text = rest[0]
        for part in rest[1:]:  # no double white space where a span was
            text = text.rstrip(b" \t") + part if part[:1].isspace() else text + part


def remove_contamination(docs: DataFrame, items: DataFrame, text_column: str = "text", min_words: int = 1,
                         max_coverage: float = 0.8, window: int = WINDOW, length_column: str | None = "n_chars",
                         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the same columns: spans found in items are cut out, documents that they cover go.

    ``min_words``: shorter hit spans stay (a span is at least a window, or a whole shorter item).
    ``length_column``, where there is one, gets the code points of a changed text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = [docs.sparkSession.sparkContext.broadcast(a) for a in automata(items, window=window, block_bytes=block_bytes)]
    schema, place = docs.schema, docs.columns.index(text_column)
    count = docs.columns.index(length_column) if length_column in docs.columns else None
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b.value for b in shared]
        for batch, texts in slices(batches, text_column):
            new = [clean_text(t, own, min_words, max_coverage) if t else t for t in texts]
            keep = [t is None or n is not None for t, n in zip(texts, new)]
            columns = list(batch.columns)
            if any(n is not t for t, n in zip(texts, new)):
                columns[place] = pa.array([None if n is None else n.decode("utf-8") for n in new], arrow.field(place).type)
                if count is not None:
                    old = columns[count].to_pylist()
                    columns[count] = pa.array([o if n is t or n is None else len(n.decode("utf-8")) for o, t, n in zip(old, texts, new)],
                                              arrow.field(count).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
