import re

import numpy as np
import pytest
import xxhash

from medallion.llm import simhash
from medallion.llm.components import components
from medallion.llm.queries import op4_simhash

from .conftest import SF


def classes(values, radius):
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(values))
    while True:
        low = np.array([label[c].min() for c in close])
        if (low == label).all():
            return label
        label = low


def clustered(rng, n):
    centres = rng.integers(0, 2**63, max(1, n // 8), dtype=np.uint64)
    values = centres[rng.integers(0, len(centres), n)]
    for _ in range(3):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        values = values ^ np.where(rng.random(n) < 0.7, flip, np.uint64(0))
    return np.unique(values)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
@pytest.mark.parametrize("n", [2, 3, 64, 65, 130, 500])
def test_bit_sliced_links(radius, n):
    values = clustered(np.random.default_rng(n), n)
    at, root = simhash.link_buckets(values, np.array([len(values)]), radius)
    label = np.arange(len(values))
    label[at] = root
    assert np.array_equal(label, classes(values, radius))


def test_large_buckets_are_split(monkeypatch):
    values = clustered(np.random.default_rng(1), 700)
    monkeypatch.setattr(simhash, "SPLIT", 50)
    at, root = simhash._link_large(values, list(range(64)), 3)
    label = np.arange(len(values))
    label[at] = root
    assert np.array_equal(label, classes(values, 3))


def test_buckets_do_not_mix():
    values = np.array([0, 1, 1, 3, 7, 2**40, 2**40 + 1], np.uint64)
    at, root = simhash.link_buckets(values, np.array([2, 1, 2, 2]), 1)
    assert sorted(zip(at.tolist(), root.tolist())) == [(1, 0), (4, 3), (6, 5)]


def test_every_close_pair_shares_a_key(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    rows = spark.createDataFrame([(int(x),) for x in np.concatenate([a, b]).view(np.int64)], "fp bigint").distinct()
    links = components(simhash.linked_fingerprints(rows)).collect()
    root = {r["node"]: r["root"] for r in links}
    assert all(x == y or root[x] == root[y] for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist()))


def test_components_of_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 103), 100)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_query_against_all_pairs(spark, document_rows):
    ids = [r["doc_id"] for r in document_rows]
    values = np.array([plain_fingerprint(r["text"]) for r in document_rows], np.uint64)
    label = classes(values, 3)
    got = sorted(map(tuple, op4_simhash(spark, SF).collect()))
    assert got == sorted((i, f"{int(v):016x}", ids[k]) for i, v, k in zip(ids, values, label))


def test_odd_rows(odd_docs, no_docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd_docs).collect()}
    assert all(got[i] == ("0" * 16, 2) for i in (2, 3, 4))
    assert got[None] == got[10] == got[1] and got[1][1] == 1 and got[5][1] == 5
    kept = simhash.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 5, 6, 7, 9] and ids.count(None) == 1
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one_of_each(no_docs).count() == 0
