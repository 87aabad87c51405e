import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from medallion.llm import langid
from medallion.llm.common import crc_mod


def test_gradients_by_differences():
    model = langid.new_model(["a", "b", "c"], 4)
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (3, 5)).astype(np.uint8)
    target, weight = np.array([0, 2, 1]), np.ones((3, 5), np.float32)
    weight[1, 3:] = 0
    for k in ("table", "gates", "candidate", "out", "bias"):
        setattr(model, k, getattr(model, k).astype(np.float64))
    _, grad = langid.gradients(model, codes, target, weight)
    for k, g in grad.items():
        a = getattr(model, k)
        places = [tuple(rng.integers(0, s) for s in a.shape) for _ in range(4)]
        if k == "table":
            places = [(way, int(codes[0, 2]), j) for way in (0, 1) for j in (1, 6, 10)]
        for at in places:
            a[at] += 1e-4
            up = langid.gradients(model, codes, target, weight)[0]
            a[at] -= 2e-4
            down = langid.gradients(model, codes, target, weight)[0]
            a[at] += 1e-4
            assert abs((up - down) / 2e-4 - g[at]) < 1e-6


def test_positions_and_pooling():
    model = langid.new_model(["a", "b"], 4)
    text = bytes(range(65, 91)) * 9
    p = langid.document_probabilities(model, [text, None, b"", b"x"])
    assert np.allclose(p[0].sum(), 1) and np.allclose(p[3].sum(), 1) and not p[1:3].any()
    codes, lengths = langid._padded([text[i:i + 64] for i in range(0, len(text), 64)])
    by_hand = sum(langid.label_positions(model, codes[i:i + 1])[:n, 0].sum(axis=0) for i, n in enumerate(lengths)) / len(text)
    assert np.allclose(by_hand, p[0], atol=1e-5)


def test_letters():
    assert langid.has_letter("é".encode()) and langid.has_letter(b"1a") and langid.has_letter("漢".encode())
    assert not langid.has_letter(b"12 !") and not langid.has_letter("²🙂".encode()) and not langid.has_letter(None)


def test_held_out_accuracy(document_rows):
    rng = random.Random(1)
    windows, held = [], []
    for r in document_rows:
        data = r["text"].encode()
        if zlib.crc32(str(r["doc_id"]).encode()) % 5:
            for _ in range(6):
                a = rng.randint(0, max(0, len(data) - 64))
                windows.append((data[a:a + 64], r["lang"]))
        else:
            held.append((data, r["lang"]))
    model = langid.train(windows)
    langs, scores = langid.predict(model, [d for d, _ in held])
    assert np.mean([a == b for a, (_, b) in zip(langs, held)]) >= 0.95
    assert ((scores >= 0) & (scores <= 1)).all()


def test_odd_rows(odd_docs, no_docs):
    model = langid.fit(odd_docs, crc_mod(odd_docs["doc_id"], 5) >= 0, steps=5)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd_docs, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (2, 3, 4, 7))
    assert all(got[i][0] in ("en", "de", "fr") for i in (1, 5, 6, 9, None))
    kept = langid.keep_identified(odd_docs, model, min_score=0.0)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, 6, 9, 10, None}
    assert {r["doc_id"] for r in langid.keep_identified(odd_docs, None).collect()} == {1, 5, 6, 9, 10, None}
    assert langid.fit(no_docs, crc_mod(no_docs["doc_id"], 5) != 0) is None
    assert langid.identify(odd_docs, None).where("lang_pred <> 'und' or score <> 0").count() == 0
    assert langid.identify(no_docs, model).count() == 0


def test_spans_of_positions(odd_docs):
    model = langid.fit(odd_docs, crc_mod(odd_docs["doc_id"], 5) >= 0, steps=5)
    text = "Été de Paris, " * 20
    spans = langid.label_text(model, text.encode())
    assert spans[0]["begin"] == 0 and spans[-1]["end"] == len(text)
    assert all(a["end"] == b["begin"] and a["lang"] != b["lang"] for a, b in zip(spans, spans[1:]))
    got = {r["doc_id"]: r["spans"] for r in langid.language_spans(odd_docs, model).collect()}
    assert got[2] == got[3] == [] and got[4][-1]["end"] == 4


def test_languages_of_any_number_are_learned(spark):
    """Three hundred rare languages beside a frequent one: all are known to the model."""
    rows = [(i, f"text of language number {i % 301} " * 3, f"l{i % 301:03}") for i in range(602)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, F.lit(True), steps=3)
    assert len(model.languages) == 301
    assert len(langid.fit(docs, F.lit(True), max_languages=5, steps=3).languages) == 5


def test_query_on_the_held_out_fifth(spark):
    from medallion.llm.queries import op3_language_id

    rows = op3_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert 0.1 < len(held) / len(rows) < 0.3
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) >= 0.95 * len(held)
