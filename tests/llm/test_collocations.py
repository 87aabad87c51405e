import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from medallion.llm import collocations
from medallion.llm.queries import ORACLES, op11_collocations

from .conftest import SF

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, longest=4, least=30, best=2000, covered=80):
    """(lang, rank, phrase, a, l, r, n, score) from whole counts and all pairs of phrases of a language."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = tuple(re.findall(r"[^ \t]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    kept = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    inside = set()
    for (lang, g), c in kept.items():
        for k in range(2, len(g)):
            inside |= {(lang, g[i:i + k]) for i in range(len(g) - k + 1) if 100 * c >= covered * f[lang, g[i:i + k]]}
    rows = []
    for lang in sorted(n):
        scored = []
        for (of, g), a in kept.items():
            if of == lang and (lang, g) not in inside:
                score, _, left, right = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        rows += [(lang, rank, phrase.decode(), -a, left, right, n[lang], -score) for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1)]
    return rows


def plain(rows):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], int(r["score"])) for r in rows)


def test_query_against_sql(spark, duck):
    from .conftest import SF as folder

    got, want = op11_collocations(spark, folder), duck.sql(ORACLES["op11_collocations"])
    assert got.columns == want.columns and dict(got.dtypes)["rank"] == "bigint"
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_small_corpus_with_a_low_limit(spark, documents, document_rows):
    got = collocations.collocations(documents, least=4).collect()
    want = brute([(r["lang"], r["text"]) for r in document_rows], least=4)
    assert plain(got) == want and len(want) > 300


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("setting", [{}, {"filter_bits": 64}, {"flush_bytes": 200}, {"longest": 2}, {"longest": 6}])
def test_random_texts(spark, seed, setting):
    """Few words, so that phrases nest and repeat; a full filter, tiny flushes and other lengths change no count."""
    rnd = random.Random(seed)
    words = ["a", "b", "A", "é", "the", "x\x00y", "\x1f", "b"]
    docs = [(rnd.choice(["en", "en", None, "und", "fr"]), "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ", ", "\n", "\r\n"]) for _ in range(rnd.randrange(0, 90))))
            for _ in range(60)]
    longest = setting.get("longest", 4)
    table = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = collocations.collocations(table, least=5, best=40, **setting).collect()
    assert plain(got) == sorted(brute(docs, longest=longest, least=5, best=40))


def test_hot_beginnings_are_spread_over_runs(spark):
    """A word before a hundred others: its extensions fill several runs, and each knows the word's own count."""
    docs = [("en", " . ".join(f"the w{i:03} end" for i in range(100)) + " . hot w007 end")] * 12
    table = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    counted = collocations.phrase_counts(table, least=10)
    streamed = collocations._streamed(counted.withColumn("mark", F.lit(False)), False)
    runs = {r["run"] for r in streamed.where("phrase like 'the %' and not copied").select("run").distinct().collect()}
    assert len(runs) >= 3
    copies = streamed.where("copied and phrase = 'the'").count()
    assert copies >= len(runs) - 1
    assert plain(collocations.collocations(table, least=10).collect()) == brute(docs, least=10)


def test_runs_hold_near_equal_rows(spark, documents):
    counted = collocations.phrase_counts(documents, least=2).withColumn("mark", F.lit(False))
    for backwards in (False, True):
        sizes = [r["count"] for r in collocations._streamed(counted, backwards).groupBy("run").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    got = collocations.collocations(odd_docs, least=2).collect()
    assert plain(got) == sorted(brute([(r["lang"], r["text"]) for r in rows], least=2))
    empty = collocations.collocations(no_docs)
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_very_long_text(spark):
    docs = [("en", "one two three four five. " * 60_000), ("fr", "x " * 400_000)]
    got = collocations.collocations(spark.createDataFrame(docs, "lang string, text string"), flush_bytes=1 << 16).collect()
    assert plain(got) == sorted(brute(docs))


def test_scores_beyond_64_bits():
    from decimal import Decimal

    import pyarrow as pa

    big = 9_000_000_000_000_000_000
    rows = [(0, ["en", "a"], big, False, False, "en", "a", []), (0, ["en", "b"], big, False, False, "en", "b", []), (0, ["en", "b", "a"], big - 1, False, False, "en", "a b", [big])]
    rows = [(0, ["en"], big, False, False, "en", "", [])] + [rows[0], rows[2], rows[1]]
    names = ["run", "key", "n", "copied", "mark", "lang", "phrase", "heads"]
    rows[2] = (0, ["en", "a", "b"], big - 1, False, False, "en", "b a", [big])
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=names)
    (out,) = collocations._backwards(80, 2_000_000)([batch])
    assert out.to_pylist()[0]["score"] == Decimal(2_000_000 * (big - 1) // (2 * big))


def test_bitmap_is_the_workers(spark):
    words, pairs = [b"a", "é".encode(), b"x\x00", b"the"], [(0, 1), (1, 0), (2, 3), (0, 0)]
    of = collocations._hashes("en", words)
    pair_hashes = collocations._pair_hashes(of[[a for a, _ in pairs]], of[[b for _, b in pairs]])
    for phrases, hashes in (([w.decode() for w in words], of), ([f"{words[a].decode()} {words[b].decode()}" for a, b in pairs], pair_hashes)):
        bitmap = collocations._bitmap(spark.createDataFrame([("en", p, 1) for p in ["", *phrases]], "lang string, phrase string, n bigint"), 1 << 16)
        want = np.zeros(1 << 10, np.uint64)
        for h in hashes.tolist():
            want[(h & 0xFFFF) >> 6] |= np.uint64(1 << (h & 63))
        assert (bitmap == want).all() and collocations._known(bitmap, hashes).all()
        assert not collocations._known(bitmap, collocations._hashes("fr", words)).any()
    assert of[0] == xxhash.xxh64_intdigest("a", xxhash.xxh64_intdigest("en", 42))
