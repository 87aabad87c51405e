import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import pitman_yor as P
from medallion.llm.queries import op9_pitman_yor

from .conftest import SF


def test_packed_arrays():
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 2**k, n, dtype=np.uint64) for k, n in ((1, 5), (9, 0), (20, 1000), (63, 77))]
    assert all(np.array_equal(a, b) for a, b in zip(arrays, P.unpack(P.pack(*arrays))))


def test_seats():
    rng = np.random.default_rng(1)
    customers = np.array([1, 2, 5, 40, 1000, 0, 3])
    tables = P.seat(customers, np.full(7, 0.5), 0.5, 6, rng)
    assert ((tables >= np.minimum(customers, 1)) & (tables <= customers)).all() and tables[0] == 1 and tables[5] == 0


def test_gibbs_reaches_the_exact_distribution():
    """Two customers, discount d, weight w for a new table: P(two tables) = w / (1 - d + w)."""
    rng = np.random.default_rng(2)
    d, w, n = 0.3, 0.4, 40_000
    tables = P.seat(np.full(n, 2), np.full(n, w), d, 4, rng)
    assert abs((tables == 2).mean() - w / (1 - d + w)) < 0.01
    # three customers: sum over the partitions with their weights
    weight = {1: w * (1 - d) * (2 - d), 2: 3 * w * w * (1 - d), 3: w**3}
    tables = P.seat(np.full(n, 3), np.full(n, w), d, 12, rng)
    for k, v in weight.items():
        assert abs((tables == k).mean() - v / sum(weight.values())) < 0.02


def exact_tables(n, w, d):
    """P(number of tables) of n customers, from all seatings' weights w^tables * prod (1 - d)...(size - 1 - d)."""
    ways = {1: 1.0}
    for k in range(1, n):
        scale = max(ways.values())
        ways = {t: (ways.get(t - 1, 0) * w + ways.get(t, 0) * (k - d * t)) / scale for t in range(1, k + 2)}
    total = sum(ways.values())
    return np.array([ways[t] / total for t in range(1, n + 1)])


@pytest.mark.parametrize("d, w", [(0.3, 0.05), (0.3, 4.0), (0.8, 0.5), (0.8, 30.0), (0.6, 200.0)])
@pytest.mark.parametrize("n, few", [(33, 512), (300, 512), (300, 16), (1500, 512)])
def test_seats_of_frequent_words_follow_the_exact_distribution(n, few, d, w):
    rng = np.random.default_rng(3)
    rows = 4_000
    want = exact_tables(n, w, d)
    tables = P.seat(np.full(rows, n), np.full(rows, w), d, 30, rng, few=few)
    t = np.arange(1, n + 1)
    mean = (want * t).sum()
    sd = math.sqrt((want * (t - mean) ** 2).sum())
    assert abs(tables.mean() - mean) < 5 * sd / math.sqrt(rows) + 1e-9
    assert np.abs(np.cumsum(np.bincount(tables, minlength=n + 1)[1:] / rows) - np.cumsum(want)).max() < 0.04


def test_a_round_goes_on_from_the_seats_it_is_given():
    """A million customers keep the exact mean of 1 + w / d tables (within 2 %), wherever they begin."""
    n, w, d, rows = 1_000_000, 2.0, 0.5, 4_000
    rng = np.random.default_rng(4)
    customers, fresh = np.full(rows, n), np.full(rows, w)
    tables, rest = P.seat_from(customers, fresh, d, 0, rng, np.full(rows, 4), np.full(rows, 9))
    assert (tables == 4).all() and (rest == 9).all()
    for _ in range(3):
        tables, rest = P.seat_from(customers, fresh, d, 4, rng, tables, rest)
    assert (rest >= tables - 1).all() and (rest < n).all()
    assert abs(tables.mean() - (1 + w / d)) < 0.02 * (1 + w / d) + 0.05


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_query(spark, document_rows):
    got = {r["doc_id"]: r for r in op9_pitman_yor(spark, SF).collect()}
    words = {r["doc_id"]: [*plain_words(r["text"]), None] for r in document_rows}
    counts = Counter()
    for i, w in words.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(w)
    total, kinds = sum(counts.values()), len(counts)
    held = [0.0, 0.0]
    for i, w in words.items():
        r = got[i]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert abs(r["base_score"] - base) <= 1e-5 * abs(base)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and r["score"] < 0
        if r["held_out"]:
            held = [held[0] + r["score"], held[1] + base]
    assert len(got) == len(words) and held[0] > held[1]  # the model beats add-one unigrams


@pytest.mark.parametrize("group_bytes, flush_tokens", [(1 << 20, 10_000), (3_000, 40)])
def test_probabilities_add_up(spark, tmp_path, group_bytes, flush_tokens):
    """After any word, the known words and the unknown one have probability one together."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 13}" for k in range(1, 30))) for i in range(20)], "doc_id bigint, text string")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    groups = -(-size // group_bytes)
    P.pack_tokens(docs, F.col("doc_id") % 7 == 2, str(tmp_path / "t"), "doc_id", "text", groups, flush_tokens)
    P.count_kinds(spark.read.parquet(str(tmp_path / "t")), groups).write.parquet(str(tmp_path / "c"))
    counts = spark.read.parquet(str(tmp_path / "c"))
    seated, kept = P.learn(counts, str(tmp_path / "s"), rounds=2, samples=2, passes=2)
    scorers = [P.Scorer(r["counts"], r["seats"], kept) for r in seated.collect()]
    assert sum(len(s.group.words) for s in scorers) == kept[0].words == 14
    for before in (b"w1", b"w5", b"", b"never seen"):
        leaf = P.context_of(before)
        chance = 0.0
        for s in scorers:
            words = s.group.words
            chance += s(words, np.arange(len(words)), np.full(len(words), leaf))[1].sum()
        unknown = scorers[0](np.array([12345], np.uint64), np.zeros(1, int), np.array([leaf]))[1][0]
        assert abs(chance + unknown - 1) < 1e-9


def test_results_do_not_depend_on_flushes(spark, documents):
    held = F.col("doc_id") % 7 == 2
    a, b = (sorted((r["doc_id"], r["n_known"], round(r["base_score"], 3)) for r in P.score_documents(documents, held, **o).collect())
            for o in ({}, {"group_bytes": 50_000, "flush_tokens": 3_000}))
    assert [x[:2] for x in a] == [x[:2] for x in b] and all(abs(x[2] - y[2]) < 0.1 for x, y in zip(a, b))


def test_base_scores_are_exact_sums(spark, documents, document_rows):
    words = {r["doc_id"]: [*plain_words(r["text"]), None] for r in document_rows}
    counts = Counter(w for i, ws in words.items() if i % 7 != 2 for w in ws)
    norm = math.log10(sum(counts.values()) + len(counts) + 1)
    for options in ({}, {"group_bytes": 50_000, "flush_tokens": 3_000}):
        for r in P.score_documents(documents, F.col("doc_id") % 7 == 2, **options).collect():
            base = math.fsum(math.log10(counts[w] + 1) - norm for w in words[r["doc_id"]])
            assert abs(r["base_score"] - base) <= 1e-9 * abs(base)


def test_odd_rows(odd_docs, no_docs):
    rows = P.score_documents(odd_docs, F.lit(False)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 11
    assert all(got[i]["n_tokens"] == 1 and got[i]["n_known"] == 1 for i in (2, 3, 4))
    assert got[2]["score"] == got[3]["score"] and got[1]["score"] == got[None]["score"] == got[10]["score"]
    assert P.score_documents(no_docs, F.lit(False)).count() == 0
    alone = P.score_documents(odd_docs, F.lit(True)).collect()  # nothing to learn from
    assert len(alone) == 11 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["score"]) < 1e-9 and abs(r["base_score"]) < 1e-9 for r in alone)
