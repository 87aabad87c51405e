"""Toxic spans by a linear-chain conditional random field (operator 7).

Labels are of documents, so the tokens of the training documents are labelled first:
a token of a toxic document is toxic when its word, or a beginning of it, is found in
toxic documents far more often than chance allows (a likelihood-ratio test over the
number of distinct training texts).  The field is then fitted to these labelled tokens: weights for a
token's word, beginnings and endings (hashed), for the words beside it, and for the
steps between the two labels, by the exact gradient of the conditional likelihood.

Scoring runs forward-backward over a document's whole token chain.  The chain is cut
into blocks only for speed: a block is first summed up as a 2 x 2 matrix, the blocks'
matrices are chained, and the marginals inside the blocks follow from that exactly.
The marginals give a document its score (a logistic function, fitted on the training
documents, of their sum and their largest), and the tokens with a marginal of at least
one half are the offending spans, with code-point offsets.

The fit uses a bounded sample: about ``toxic_rows`` and ``clean_rows`` labels (twice as
many at most), drawn by a hash of the id, and of these the usable documents of at most
``train_bytes``.  The chains are fitted on windows of ``window`` tokens: ``windows`` at most of a toxic
document, drawn from all its toxic tokens, one of a clean one.  Every document is scored, whole.

Defined results: null, empty and wordless texts have no tokens and get the score of no
evidence; so do all texts where nothing could be learned (score 0); repeated rows get
equal scores; labels that are null are not learned from.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.bpe import Memo
from medallion.llm.common import hash_share, segments, slices, within
from medallion.llm.decontaminate import words_of

TOXIC_ROWS = 1800
CLEAN_ROWS = 5400
TRAIN_BYTES = 20_000
BLOCK = 128
#: Windows that a toxic training text gives at most.
WINDOWS = 4
_FEATURES = 1 << 20
#: Words whose weights a worker remembers.
WORDS = 120_000
#: Marginals below this count as no evidence for the document.
LIKELY = 0.2
#: Ridge of the logistic regression over the documents.
DAMPING = 0.02
_WORD_AT = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Twice the log-likelihood ratio at which a word counts as found too often by chance
#: (the tail of chi-squared beyond it is about 1e-7).
EVIDENCE = 28.0


def beginnings(word: bytes) -> list[bytes]:
    """The word itself and its first 4 to 7 bytes, marked apart."""
    return [b"=" + word] + [b"^" + word[:n] for n in range(4, 8) if len(word) > n]


def features(word: bytes) -> np.ndarray:
    """Hashed features of a word by itself."""
    own = beginnings(word) + [b"$" + word[-n:] for n in (3, 5) if len(word) > n] + [b"#%d" % min(len(word), 12)]
    return np.array([zlib.crc32(f) % _FEATURES for f in own], np.int64)


def token_lexicon(docs: list[list[bytes]], toxic: list[int], evidence: float = EVIDENCE) -> set[bytes]:
    """Words and beginnings that toxic documents have far more often than chance allows."""
    seen: dict[tuple, int] = {}
    for words, label in zip(docs, toxic):
        seen.setdefault(tuple(words), label)  # copies of a text are one piece of evidence
    total = Counter(seen.values())
    if not total[1] or not total[0]:
        return set()
    share = total[1] / len(seen)
    found = Counter(f for words, label in seen.items() if label for f in {f for w in set(words) for f in beginnings(w)})
    # fewer documents than this can't reach the evidence, even if no clean one has it
    least = evidence / (-2 * np.log(share))
    found = {f: k for f, k in found.items() if k >= least}
    clean = Counter(f for words, label in seen.items() if not label for f in {f for w in set(words) for f in beginnings(w)} if f in found)
    out = set()
    for f, k1 in found.items():
        k0 = clean[f]
        k = k1 + k0
        if k1 / total[1] < 8 * (k0 + 0.5) / (total[0] + 1):
            continue
        g = 2 * (k1 * np.log(k1 / (k * share)) + (k0 * np.log(k0 / (k * (1 - share))) if k0 else 0))
        if g >= evidence:
            out.add(f)
    return out


@dataclass
class Field:
    """``own``/``beside``: weights of a word's features for its own token and for the tokens next to it."""

    own: np.ndarray = field(default_factory=lambda: np.zeros(_FEATURES, np.float32))
    beside: np.ndarray = field(default_factory=lambda: np.zeros(_FEATURES, np.float32))
    bias: float = -4.0
    steps: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    first: float = 0.0  # the toxic label's extra weight at the first token
    document: np.ndarray = field(default_factory=lambda: np.array([-4.0, 4.0, 4.0]))  # bias, log1p of the sum, the largest

    def __post_init__(self):
        self._words = Memo(self._weights, WORDS)

    def _weights(self, word: bytes) -> tuple[float, float]:
        f = features(word)
        return float(self.own[f].sum()), float(self.beside[f].sum())

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_words"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._words = Memo(self._weights, WORDS)

    def evidence(self, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """For chains laid end to end, every token's weight for the toxic label (against the clean one)."""
        n = len(words)
        w = np.fromiter((x for pair in map(self._words.__getitem__, words) for x in pair), np.float64, 2 * n).reshape(n, 2)
        out = w[:, 0] + self.bias
        place = within(lengths)
        chain = np.repeat(lengths, lengths)
        before, after = place > 0, place < chain - 1
        out[before] += w[np.flatnonzero(before) - 1, 1]
        out[after] += w[np.flatnonzero(after) + 1, 1]
        out[place == 0] += self.first
        return out


def marginals(evidence: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """P(toxic) of every token of chains laid end to end, by forward-backward.

    ``evidence`` is each token's weight for label 1; ``steps[i, j]`` the weight of label i before label j.
    """
    if not len(evidence):
        return np.zeros(0)
    a = np.exp(steps - steps.max())
    e = np.exp(np.clip(evidence, -30, 30))
    blocks = -(-lengths // BLOCK)
    owner = segments(blocks)  # chain of each block
    nth = within(blocks)
    size = np.minimum(lengths[owner] - nth * BLOCK, BLOCK)
    begin = np.cumsum(size) - size
    order = begin[:, None] + np.arange(BLOCK)
    real = np.arange(BLOCK) < size[:, None]
    grid = np.where(real, e[np.minimum(order, len(e) - 1)], 0).T  # time, block
    live = real.T
    n = len(size)
    # each block as a matrix: from the label before it to the label at its end
    head = nth == 0
    p = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, n)).copy()
    p[:, 1] *= np.where(head, grid[0], 1)  # a chain's first token has no step before it
    for t in range(int(size.max())):
        on = live[t] & ~head if t == 0 else live[t]
        q0 = p[:, 0] * a[0, 0] + p[:, 1] * a[1, 0]
        q1 = (p[:, 0] * a[0, 1] + p[:, 1] * a[1, 1]) * grid[t]
        scale = (q0 + q1).sum(axis=0)
        p[:, 0] = np.where(on, q0 / scale, p[:, 0])
        p[:, 1] = np.where(on, q1 / scale, p[:, 1])
    # labels' weights before (forwards) and after (backwards) every block of its chain
    start = np.ones((2, n))
    end = np.ones((2, n))
    at = np.cumsum(blocks) - blocks
    for k in range(1, int(blocks.max())):
        now = (at + k)[blocks > k]
        f = start[0, now - 1] * p[0, :, now - 1].T + start[1, now - 1] * p[1, :, now - 1].T
        start[:, now] = f / f.sum(axis=0)
    last = at + blocks - 1
    for k in range(1, int(blocks.max())):
        now = (last - k)[blocks > k]
        b = p[:, 0, now + 1] * end[0, now + 1] + p[:, 1, now + 1] * end[1, now + 1]
        end[:, now] = b / b.sum(axis=0)
    forward = np.empty((len(grid), 2, n))
    f = start
    for t in range(int(size.max())):
        if t == 0:
            f0 = np.where(head, 1.0, f[0] * a[0, 0] + f[1] * a[1, 0])
            f1 = np.where(head, 1.0, f[0] * a[0, 1] + f[1] * a[1, 1]) * grid[t]
        else:
            f0, f1 = f[0] * a[0, 0] + f[1] * a[1, 0], (f[0] * a[0, 1] + f[1] * a[1, 1]) * grid[t]
        s = f0 + f1
        f = np.stack([np.where(live[t], f0 / s, f[0]), np.where(live[t], f1 / s, f[1])])
        forward[t] = f
    out = np.zeros((len(grid), n))
    b = end
    for t in range(int(size.max()) - 1, -1, -1):
        one, zero = forward[t, 1] * b[1], forward[t, 0] * b[0]
        out[t] = one / (one + zero)
        g = b[1] * grid[t]
        b0, b1 = a[0, 0] * b[0] + a[0, 1] * g, a[1, 0] * b[0] + a[1, 1] * g
        s = b0 + b1
        b = np.stack([np.where(live[t], b0 / s, b[0]), np.where(live[t], b1 / s, b[1])])
    return out.T[real]


def evidence_of_documents(model: Field, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals of all tokens, their document, per document [1, log1p of the sum, the largest])."""
    lengths = np.array([len(d) for d in docs], np.int64)
    used = lengths > 0
    p = marginals(model.evidence([w for d in docs for w in d], lengths[used]), lengths[used], model.steps)
    owner = segments(lengths)
    total = np.bincount(owner, np.where(p >= LIKELY, p, 0), len(docs))  # else a long text adds up to evidence
    most = np.zeros(len(docs))
    np.maximum.at(most, owner, p)
    return p, owner, np.stack([np.ones(len(docs)), np.log1p(total), most], axis=1)


def scores(model: Field | None, docs: list[list[bytes]]) -> np.ndarray:
    if model is None:
        return np.zeros(len(docs))
    return 1 / (1 + np.exp(-evidence_of_documents(model, docs)[2] @ model.document))


def train(texts: list[tuple[bytes, int]], rounds: int = 80, window: int = 40, windows: int = WINDOWS, seed: int = 11) -> Field | None:
    """Fit the field to labelled texts; None where one of the two labels is missing.

    A toxic text gives ``windows`` windows at most of ``window`` tokens, around tokens drawn from all its toxic
    ones; a clean text gives one, drawn from all its tokens.
    """
    texts = sorted(set(texts), key=lambda x: (zlib.crc32(x[0]), x))
    docs, toxic = [words_of(t) for t, _ in texts], [int(y) for _, y in texts]
    lexicon = token_lexicon(docs, toxic)
    if not lexicon:
        return None
    rng = np.random.default_rng(seed)
    chains, labels = [], []
    fitted = [i for i in range(len(docs)) if i % 3 or len(docs) < 30]  # the rest sets the documents' scale
    for words, y in ((docs[i], toxic[i]) for i in fitted):
        marked = [int(y and not lexicon.isdisjoint(beginnings(w))) for w in words]
        toxic_at = np.flatnonzero(marked) if y else np.zeros(0, np.int64)
        at = sorted(rng.choice(toxic_at, min(windows, len(toxic_at)), replace=False).tolist())
        for i in at or ([int(rng.integers(0, len(words)))] if words else []):
            lo = max(0, i - window // 2)
            chains.append(words[lo:lo + window])
            labels.append(marked[lo:lo + window])
    model = Field()
    _fit_chains(model, chains, labels, rounds)
    rest = sorted(set(range(len(docs))) - set(fitted)) or fitted
    x, y = evidence_of_documents(model, [docs[i] for i in rest])[2], np.array([toxic[i] for i in rest], float)
    w = model.document.copy()
    for _ in range(50):  # Newton steps of a slightly damped logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + DAMPING * np.eye(3)
        w = w - np.linalg.solve(h, x.T @ (q - y) + DAMPING * w * [0, 1, 1])
    model.document = w
    return model


def _fit_chains(model: Field, chains: list[list[bytes]], labels: list[list[int]], rounds: int, rate: float = 0.3, decay: float = 1e-4) -> None:
    """Adam on the exact gradient: features' empirical less expected counts."""
    lengths = np.array([len(c) for c in chains])
    words = [w for c in chains for w in c]
    y = np.array([v for c in labels for v in c], float)
    types: dict[bytes, int] = {}
    code = np.array([types.setdefault(w, len(types)) for w in words])
    lists = [features(w) for w in types]
    feature, of_type = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    place, chain = within(lengths), np.repeat(lengths, lengths)
    first, before, after = place == 0, np.flatnonzero(place > 0), np.flatnonzero(place < chain - 1)
    moves = before  # tokens with a step into them
    parts = {"own": np.zeros(_FEATURES), "beside": np.zeros(_FEATURES), "rest": np.array([model.bias, model.first, 0, 0, 0, 0], float)}
    m = {k: np.zeros_like(v) for k, v in parts.items()}
    v = {k: np.zeros_like(x) for k, x in parts.items()}
    n = len(words)
    for step in range(1, rounds + 1):
        steps = parts["rest"][2:].reshape(2, 2)
        own = np.bincount(of_type, parts["own"][feature], len(types))[code]
        beside = np.bincount(of_type, parts["beside"][feature], len(types))[code]
        e = own + parts["rest"][0] + first * parts["rest"][1]
        e[before] += beside[before - 1]
        e[after] += beside[after + 1]
        p = marginals(e, lengths, steps)
        d = y - p  # gradient of the likelihood by each token's weight
        near = np.zeros(n)
        near[before - 1] += d[before]
        near[after + 1] += d[after]
        pair = _pair_counts(e, lengths, steps, p, moves)
        seen = np.array([[np.sum((1 - y[moves - 1]) * (1 - y[moves])), np.sum((1 - y[moves - 1]) * y[moves])],
                         [np.sum(y[moves - 1] * (1 - y[moves])), np.sum(y[moves - 1] * y[moves])]])
        grad = {"own": np.bincount(feature, np.bincount(code, d, len(types))[of_type], _FEATURES),
                "beside": np.bincount(feature, np.bincount(code, near, len(types))[of_type], _FEATURES),
                "rest": np.concatenate([[d.sum(), d[first].sum()], (seen - pair).ravel()])}
        for k, g in grad.items():
            g = g / n - decay * parts[k] * (k != "rest")
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            parts[k] += rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)
    model.own, model.beside = parts["own"].astype(np.float32), parts["beside"].astype(np.float32)
    model.bias, model.first, model.steps = float(parts["rest"][0]), float(parts["rest"][1]), parts["rest"][2:].reshape(2, 2)
    model._words = Memo(model._weights, WORDS)


def _pair_counts(e: np.ndarray, lengths: np.ndarray, steps: np.ndarray, p: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Expected number of each step, from the marginals at both ends and the odds ratio of the chain.

    For two labels, P(i, j) of neighbours has the marginals p and an odds ratio that only the step weights
    set: a[0,0] a[1,1] / (a[0,1] a[1,0]); that determines it.
    """
    k = np.exp(steps[0, 0] + steps[1, 1] - steps[0, 1] - steps[1, 0])
    x, y = p[moves - 1], p[moves]
    if abs(k - 1) < 1e-9:
        both = x * y
    else:
        s = 1 + (x + y) * (k - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * k * (k - 1) * x * y, 0))) / (2 * (k - 1))
    return np.array([[np.sum(1 - x - y + both), np.sum(y - both)], [np.sum(x - both), np.sum(both)]])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
        toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, train_bytes: int = TRAIN_BYTES) -> Field | None:
    """Train on a bounded sample of the labelled documents where ``usable`` (over ``docs``) holds."""
    marks = (labels.where(labels[label_column].isin(0, 1)).groupBy(labels[id_column].alias("id"))
             .agg(F.max(label_column).alias("y"), F.min(label_column).alias("low")).where("y = low").select("id", "y"))
    wanted = {1: toxic_rows, 0: clean_rows}
    shares = {r["y"]: min(1.0, wanted[r["y"]] / r["n"]) for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return None
    drawn = marks.where(hash_share(F.xxhash64("id")) < F.when(F.col("y") == 1, shares[1]).otherwise(shares[0]))
    chosen = drawn.orderBy(F.xxhash64("id"), "id").limit(2 * (toxic_rows + clean_rows)).collect()
    picked = docs.sparkSession.createDataFrame(chosen, drawn.schema)
    text = docs[text_column].cast("binary")
    rows = docs.where(usable & (F.octet_length(text) <= train_bytes)).select(docs[id_column].alias("id"), text.alias("text"))
    found = rows.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("text").alias("text")).collect()
    return train([(bytes(r["text"]), r["y"]) for r in found])


def score_documents(docs: DataFrame, model: Field | None, id_column: str = "doc_id", text_column: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """(id, score, predicted, spans): spans are [begin, end) code points of the offending tokens, neighbours joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, texts in slices(batches, "text"):
            words = [words_of(t) for t in texts]
            spans: list[list[dict]] = [[] for _ in texts]
            if own is None:
                value = np.zeros(len(texts))
            else:
                p, owner, x = evidence_of_documents(own, words)
                value = 1 / (1 + np.exp(-x @ own.document))
                begin = np.cumsum(np.bincount(owner, minlength=len(texts))) if len(owner) else np.zeros(len(texts), int)
                for d in np.unique(owner[p >= 0.5]).tolist():
                    stop = int(begin[d])
                    spans[d] = offsets(texts[d], np.flatnonzero(p[stop - len(words[d]):stop] >= 0.5).tolist())
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "score": pa.array(value, pa.float64()),
                "predicted": pa.array((value >= threshold).astype(np.int32)),
                "spans": pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))})

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, score double, predicted int, spans array<struct<begin:int,end:int>>") \
        .withColumnRenamed("id", id_column)


def offsets(text: bytes, tokens: list[int]) -> list[dict]:
    """Code-point intervals of the numbered tokens of a text."""
    at = [m.span() for m in _WORD_AT.finditer(text)]
    joined: list[list[int]] = []
    for t in tokens:
        if joined and joined[-1][1] == t:
            joined[-1][1] = t + 1
        else:
            joined.append([t, t + 1])
    out, done, points = [], 0, 0
    for a, b in joined:
        begin, end = at[a][0], at[b - 1][1]
        points += len(text[done:begin].decode("utf-8"))
        size = len(text[begin:end].decode("utf-8"))
        out.append({"begin": points, "end": points + size})
        points, done = points + size, end
    return out


def keep_clean(docs: DataFrame, model: Field | None, text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that score at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text_column):
            value = scores(shared.value, [words_of(t) for t in texts])
            yield batch.filter(pa.array(value < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
