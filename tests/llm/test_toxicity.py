import itertools
import zlib

import numpy as np
import pytest

from medallion.llm import toxicity as T
from medallion.llm.common import crc_mod


@pytest.mark.parametrize("block", [1, 3, 128])
def test_marginals_against_all_labellings(monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    rng = np.random.default_rng(0)
    for _ in range(25):
        lengths = rng.integers(1, 9, 4)
        evidence, steps = rng.normal(0, 2, lengths.sum()), rng.normal(0, 1, (2, 2))
        got, at = T.marginals(evidence, lengths, steps), 0
        for n in lengths:
            total, one = 0.0, np.zeros(n)
            for y in itertools.product((0, 1), repeat=int(n)):
                w = np.exp(sum(evidence[at + i] * y[i] for i in range(n)) + sum(steps[y[i], y[i + 1]] for i in range(n - 1)))
                total += w
                one += w * np.array(y)
            assert np.allclose(one / total, got[at:at + n])
            at += n


def test_pair_counts_against_all_labellings():
    rng = np.random.default_rng(1)
    evidence, steps, n = rng.normal(0, 1, 6), rng.normal(0, 1, (2, 2)), 6
    lengths = np.array([n])
    total, pairs = 0.0, np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(e * v for e, v in zip(evidence, y)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
        total += w
        for a, b in zip(y, y[1:]):
            pairs[a, b] += w
    p = T.marginals(evidence, lengths, steps)
    assert np.allclose(T._pair_counts(evidence, lengths, steps, p, np.arange(1, n)), pairs / total)


def test_offsets():
    text = "Été: you idiot, moron! 🙂 scum".encode()
    words = T.words_of(text)
    marked = [i for i, w in enumerate(words) if w in (b"idiot", b"moron", b"scum")]
    spans = T.offsets(text, marked)
    assert [text.decode()[s["begin"]:s["end"]] for s in spans] == ["idiot, moron", "scum"]


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels


def test_held_out_rows(labelled):
    docs, labels = labelled
    model = T.fit(docs, labels, crc_mod(docs["doc_id"], 3) != 1)
    rows = {r["doc_id"]: r for r in T.score_documents(docs, model).collect()}
    truth = [(r["doc_id"], r["toxic"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    toxic = np.array([rows[i]["score"] for i, y in truth if y])
    clean = np.array([rows[i]["score"] for i, y in truth if not y])
    # few toxic documents to learn from here: most are found and clean ones are left alone
    assert (clean >= 0.7).mean() <= 0.02
    assert np.mean([(t > clean).mean() for t in toxic]) >= 0.8
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows.values())


def test_odd_rows(spark, odd_docs, no_docs, labelled):
    docs, labels = labelled
    model = T.fit(docs, labels, crc_mod(docs["doc_id"], 3) != 1)
    got = {r["doc_id"]: (r["score"], r["spans"]) for r in T.score_documents(odd_docs, model).collect()}
    assert got[2] == got[3] == got[4] and got[2][0] < 0.5 and got[1] == got[None] == got[10]
    kept = T.keep_clean(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert T.score_documents(no_docs, model).count() == 0
    assert {r["score"] for r in T.score_documents(odd_docs, None).collect()} == {0.0}
    assert T.fit(no_docs, labels, crc_mod(no_docs["doc_id"], 3) != 1) is None
    nulls = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0)], "doc_id bigint, toxic int")
    assert T.fit(odd_docs, nulls, crc_mod(odd_docs["doc_id"], 3) != 1) is None


def test_windows_come_from_the_whole_text(monkeypatch):
    """Toxic tokens far behind the first four are fitted too, and no more windows than the parameter says."""
    seen = []
    monkeypatch.setattr(T, "_fit_chains", lambda model, chains, labels, rounds: seen.append(chains))
    filler = " ".join(f"plain{i}" for i in range(60))
    toxic = [" ".join(f"x{j} {filler} badword{'s' * (k % 2)}" for k in range(12)).encode() for j in range(40)]
    clean = [f"some words of text number {j} {filler}".encode() for j in range(40)]
    T.train([(t, 1) for t in toxic] + [(t, 0) for t in clean], rounds=1, windows=3)
    chains = seen[0]
    bad = [c for c in chains if any(w.startswith(b"badword") for w in c)]
    assert bad and len(bad) <= 3 * 40


def test_query_on_the_held_out_third(spark):
    from medallion.llm.queries import op7_toxicity

    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in op7_toxicity(spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r["toxic"] is not None}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    held = {i: y for i, y in labels.items() if i in rows and rows[i]["held_out"]}
    toxic = [rows[i]["predicted"] for i, y in held.items() if y]
    clean = [rows[i]["predicted"] for i, y in held.items() if not y]
    assert sum(toxic) >= 0.5 * len(toxic) > 0 and sum(clean) <= 0.02 * len(clean)
