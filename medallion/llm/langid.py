"""Language identification by a bidirectional gated recurrent network over bytes (operator 3).

A text's UTF-8 bytes (A-Z in lower case) are cut into segments of ``SEGMENT`` bytes.  One
GRU reads every segment forwards, another backwards; their states at a byte give that
byte's probabilities of the languages, and a document's probabilities are the mean over
all its bytes.  Segments of many documents run through the network together.

Training: back-propagation through time in numpy (Adam, cross-entropy at every byte) on
the driver, on a bounded sample: about ``rows_per_language`` labelled rows of each
language (twice as many at most), ``windows`` segments of each, all drawn by hashes.  All
languages are learned, and the sample, the model and its pass grow with their number;
``max_languages`` keeps to the most frequent.  Only the text and the language of the training rows are used.

Defined results: ``und`` with score 0 for null, empty and letterless texts, and for all
texts where nothing could be learned; equal probabilities go to the language that sorts
first; repeated rows get the same answer; very long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import hash_share, slices

UNDETERMINED = "und"
SEGMENT = 64
HIDDEN = 8
ROWS_PER_LANGUAGE = 700
WINDOWS = 3
#: The most frequent languages that are learned; None for all.
MAX_LANGUAGES = None
STEPS = 350
BATCH = 192
_AT_ONCE = 4096  # segments in one run of the network

_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (_LETTER.search(text) is not None or any(c.isalpha() for c in text.decode("utf-8")))


@dataclass
class Model:
    """Per direction (0 forwards, 1 backwards): input table, recurrent weights, output weights; and the output bias."""

    languages: list[str]
    table: np.ndarray  # (2, 256, 3h): what a byte adds to update gate, reset gate and candidate
    gates: np.ndarray  # (2, h, 2h)
    candidate: np.ndarray  # (2, h, h)
    out: np.ndarray  # (2, h, languages)
    bias: np.ndarray


def new_model(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    return Model(languages, draw(2, 256, 3 * hidden), draw(2, hidden, 2 * hidden), draw(2, hidden, hidden),
                 draw(2, hidden, len(languages)), np.zeros(len(languages), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def label_positions(model: Model, codes: np.ndarray) -> np.ndarray:
    """Language probabilities at every byte: codes (segments, time) -> (time, segments, languages)."""
    n, time = codes.shape
    hidden = model.candidate.shape[1]
    logits = np.empty((time, n, len(model.languages)), np.float32)
    logits[:] = model.bias
    columns = np.ascontiguousarray(codes.T)
    for way in (0, 1):
        table, gates, candidate, out = model.table[way], model.gates[way], model.candidate[way], model.out[way]
        h = np.zeros((n, hidden), np.float32)
        for t in range(time) if way == 0 else range(time - 1, -1, -1):
            x = table[columns[t]]
            g = h @ gates
            g += x[:, :2 * hidden]
            _sigmoid(g)
            c = (g[:, hidden:] * h) @ candidate
            c += x[:, 2 * hidden:]
            np.tanh(c, out=c)
            c -= h
            c *= g[:, :hidden]
            h = h + c
            logits[t] += h @ out
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


def _run(model: Model, way: int, columns: np.ndarray):
    """Forward pass of one direction that keeps what back-propagation needs."""
    hidden = model.candidate.shape[1]
    time, n = columns.shape
    h = np.zeros((n, hidden), np.float32)
    kept = []
    for t in range(time) if way == 0 else range(time - 1, -1, -1):
        x = model.table[way][columns[t]]
        g = _sigmoid(h @ model.gates[way] + x[:, :2 * hidden])
        z, r = g[:, :hidden], g[:, hidden:]
        c = np.tanh((r * h) @ model.candidate[way] + x[:, 2 * hidden:])
        new = h + z * (c - h)
        kept.append((t, h, z, r, c, new))
        h = new
    return kept


def gradients(model: Model, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over weighted bytes and its gradients, through time in both directions."""
    hidden = model.candidate.shape[1]
    columns = np.ascontiguousarray(codes.T)
    time, n = columns.shape
    runs = [_run(model, way, columns) for way in (0, 1)]
    logits = np.tile(model.bias, (time, n, 1))
    for way, kept in enumerate(runs):
        for t, *_, new in kept:
            logits[t] += new @ model.out[way]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    w = weight.T / weight.sum()
    rows = np.arange(n)
    loss = float(-(np.log(p[:, rows, target] + 1e-9) * w).sum())
    p[:, rows, target] -= 1
    p *= w[:, :, None]
    grad = {k: np.zeros_like(getattr(model, k)) for k in ("table", "gates", "candidate", "out", "bias")}
    grad["bias"] = p.sum(axis=(0, 1))
    for way, kept in enumerate(runs):
        carry = np.zeros((n, hidden), np.float32)
        to_x = np.empty((time, n, 3 * hidden), np.float32)
        for t, h, z, r, c, new in reversed(kept):
            grad["out"][way] += new.T @ p[t]
            dh = carry + p[t] @ model.out[way].T
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * z * (1 - z)
            into = dc @ model.candidate[way].T
            dr = into * h * r * (1 - r)
            dg = np.concatenate([dz, dr], axis=1)
            grad["candidate"][way] += (r * h).T @ dc
            grad["gates"][way] += h.T @ dg
            carry = dh * (1 - z) + into * r + dg @ model.gates[way].T
            to_x[t] = np.concatenate([dg, dc], axis=1)
        flat = to_x.reshape(-1, 3 * hidden)
        order = columns.ravel()
        for k in range(3 * hidden):
            grad["table"][way][:, k] = np.bincount(order, flat[:, k], 256)
    return loss, grad


def train(windows: list[tuple[bytes, str]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 7,
          rate: float = 0.02) -> Model | None:
    """A model of the windows' languages; None where there is nothing to learn from."""
    windows = sorted((w, lang) for w, lang in windows if w)
    if not windows:
        return None
    languages = sorted({lang for _, lang in windows})
    model = new_model(languages, hidden, seed)
    codes, lengths = _padded([w for w, _ in windows])
    target = np.array([languages.index(lang) for _, lang in windows])
    weight = (np.arange(SEGMENT) < lengths[:, None]).astype(np.float32)
    rng = np.random.default_rng(seed)
    first = {k: 0.0 for k in ("table", "gates", "candidate", "out", "bias")}
    second = dict(first)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), batch)
        _, grad = gradients(model, codes[pick], target[pick], weight[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g / max(1.0, size)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            change = pace * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
            setattr(model, k, (getattr(model, k) - change).astype(np.float32))
    return model


def _padded(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in segments])
    return np.frombuffer(b"".join(s.lower().ljust(SEGMENT, b" ") for s in segments), np.uint8).reshape(-1, SEGMENT), lengths


def document_probabilities(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """(documents, languages): the mean of the bytes' probabilities; zero rows for empty texts."""
    out = np.zeros((len(texts), len(model.languages)))
    sizes = np.array([len(t) if t else 0 for t in texts])
    counts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    if not len(owner):
        return out
    data = b"".join(t.lower().ljust(c * SEGMENT, b" ") for t, c in zip(texts, counts.tolist()) if c)
    codes = np.frombuffer(data, np.uint8).reshape(-1, SEGMENT)
    ends = np.cumsum(counts)
    lengths = np.full(len(codes), SEGMENT)
    some = counts > 0
    lengths[ends[some] - 1] = sizes[some] - (counts[some] - 1) * SEGMENT
    for at in range(0, len(codes), _AT_ONCE):
        p = label_positions(model, codes[at:at + _AT_ONCE])
        short = lengths[at:at + _AT_ONCE]
        p *= (np.arange(SEGMENT)[:, None] < short)[:, :, None]
        np.add.at(out, owner[at:at + _AT_ONCE], p.sum(axis=0))
    return out / np.maximum(sizes, 1)[:, None]


def predict(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    """(language, score) of every text."""
    if model is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    known = [has_letter(t) for t in texts]
    p = document_probabilities(model, [t if k else None for t, k in zip(texts, known)])
    best = p.argmax(axis=1)
    langs = [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known)]
    return langs, np.where(known, np.clip(p[np.arange(len(texts)), best], 0, 1), 0.0)


def fit(docs: DataFrame, usable: Column, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id",
        max_languages: int | None = MAX_LANGUAGES, rows_per_language: int = ROWS_PER_LANGUAGE,
        windows: int = WINDOWS, **options) -> Model | None:
    """Train on a bounded sample of the rows where ``usable`` holds and the language is not null."""
    text = docs[text_column].cast("binary")
    rows = (docs.where(usable & docs[lang_column].isNotNull() & (F.octet_length(text) > 0))
            .select(text.alias("text"), docs[lang_column].alias("lang"), F.xxhash64(docs[id_column], text).alias("h")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    if max_languages is not None:
        counts = counts.orderBy(F.desc("n"), "lang").limit(max_languages)
    counts = counts.collect()  # one row a language
    if not counts:
        return None
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, rows_per_language / r["n"])) for r in counts], "lang string, share double")
    # only the windows leave the tasks, not the texts
    at = lambda k: F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(F.lit(1), F.octet_length("text") - SEGMENT + 1)).cast("int") + 1
    cut = F.array(*(F.substring("text", at(k), F.lit(SEGMENT)) for k in range(windows)))
    found = (rows.join(F.broadcast(shares), "lang").where(hash_share(F.col("h")) < F.col("share")).select("lang", "h", cut.alias("cut"))
             .orderBy("h", "lang").limit(2 * rows_per_language * len(counts)).collect())
    return train([(bytes(w), r["lang"]) for r in found for w in r["cut"]], **options)


def identify(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            langs, scores = predict(shared.value, texts)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "lang_pred": pa.array(langs, pa.string()),
                                              "score": pa.array(scores, pa.float64())})

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, lang_pred string, score double") \
        .withColumnRenamed("id", id_column)


def label_text(model: Model, text: bytes | None) -> list[dict]:
    """Runs of code points with the same most probable language, in order; they cover the text."""
    if not text:
        return []
    codes, _ = _padded([text[i:i + SEGMENT] for i in range(0, len(text), SEGMENT)])
    label = np.concatenate([label_positions(model, codes[at:at + _AT_ONCE]).argmax(axis=2).T.ravel() for at in range(0, len(codes), _AT_ONCE)])
    # a code point has the label of its last byte
    octets = np.frombuffer(text, np.uint8)
    last = np.append(octets[1:] & 0xC0 != 0x80, True)
    label = label[:len(octets)][last]
    edges = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1], [True]])).tolist()
    return [{"begin": a, "end": b, "lang": model.languages[label[a]]} for a, b in zip(edges, edges[1:])]


def language_spans(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans): the positions' languages of every document, as runs [begin, end) of code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "spans": pa.array([label_text(shared.value, t) for t in texts], kind)})

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, spans array<struct<begin:int,end:int,lang:string>>") \
        .withColumnRenamed("id", id_column)


def keep_identified(docs: DataFrame, model: Model | None, text_column: str = "text", languages: list[str] | None = None,
                    min_score: float = 0.0) -> DataFrame:
    """``docs`` without the documents whose language is undetermined, not in ``languages`` or scored under ``min_score``.

    Without a model (nothing to learn from) only the letterless documents go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_column):
            if shared.value is None:
                yield batch.filter(pa.array([has_letter(t) for t in texts], pa.bool_()))
                continue
            langs, scores = predict(shared.value, texts)
            keep = [lang != UNDETERMINED and score >= min_score and (languages is None or lang in languages)
                    for lang, score in zip(langs, scores.tolist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
