import random

import duckdb
import pytest

from medallion.llm import decontaminate as D
from medallion.llm.queries import ORACLES, op2_decontamination

from .conftest import SF


def brute(words, items, window):
    hit, names = set(), set()
    for name, item in items:
        k = min(len(item), window)
        if not k:
            continue
        grams = {tuple(item[i:i + k]) for i in range(len(item) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                names.add(name)
    return hit, names


def test_automaton_against_windows():
    rng = random.Random(5)
    for n in range(250):
        letters = [b"a", b"b", b"c", b"d"][:rng.randint(1, 4)]
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(0, 12))]) for i in range(rng.randint(0, 5))]
        window = rng.randint(1, 5)
        automaton = D.SuffixAutomaton(items, window)
        for _ in range(4):
            words = [rng.choice([*letters, b"x"]) for _ in range(rng.randint(0, 40))]
            if items and rng.random() < 0.5:
                words[5:5] = rng.choice(items)[1]
            spans, names = automaton.matches(words)
            assert ({i for a, b in spans for i in range(a, b)}, names) == brute(words, items, window)


def test_words():
    assert D.words_of("A b-C, Été 12_x!".encode()) == [b"a", b"b", b"c", "Été".encode(), b"12", b"x"]
    assert D.words_of(None) == D.words_of(b"") == []


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def test_cutting_spans():
    a = [D.SuffixAutomaton([("1", D.words_of(ITEM.encode())), ("2", [b"short", b"item"])])]
    text = f"Before it all. {ITEM.upper()}, after it there is a lot more text that stays as it was."
    assert D.clean_text(text.encode(), a, 1, 0.8) == b"Before it all. , after it there is a lot more text that stays as it was."
    assert D.clean_text(b"a short item b", a, 1, 0.8) == b"a b"
    assert D.clean_text(b"a short item b", a, 5, 0.8) == b"a short item b"
    assert D.clean_text(ITEM.encode(), a, 1, 0.8) is None
    # cutting joins two halves of the passage: it is searched again
    nested = " ".join([*ITEM.split()[:6], "short item", *ITEM.split()[6:], "and", "many", "other", "words", "go", "on", "here", "and", "there"])
    assert not D.SuffixAutomaton([("1", D.words_of(ITEM.encode()))]).matches(D.words_of(D.clean_text(nested.encode(), a, 1, 0.9)))[0]
    assert D.clean_text(b"nothing here", a, 1, 0.8) == b"nothing here"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog and the cat"), (2, None), (3, ""), (4, "Fuchs springt"),
                                  (4, "faulen Hund"), (None, "456"), (5, "--")], "item_id bigint, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_odd_rows(odd_docs, items, block_bytes):
    got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in D.match_documents(odd_docs, items, block_bytes=block_bytes).collect()}
    assert {(1, 12, 11, ("1",)), (2, 0, 0, ()), (3, 0, 0, ()), (4, 0, 0, ()), (5, 9, 4, ("4",)), (7, 2, 1, ()), (None, 12, 11, ("1",)),
            (10, 12, 11, ("1",))} <= got
    assert D.match_documents(odd_docs, items).count() == odd_docs.count()


def test_no_items_no_documents(odd_docs, no_docs, items):
    assert D.match_documents(odd_docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert D.match_documents(no_docs, items).count() == 0
    assert D.remove_contamination(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_documents_keep_their_columns(odd_docs, items):
    kept = D.remove_contamination(odd_docs, items)
    assert kept.columns == odd_docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert 1 not in rows and 10 not in rows  # covered by an item
    assert rows[5]["text"] == "Der schnelle braune über den ." and rows[5]["n_chars"] == len(rows[5]["text"])
    assert rows[2]["text"] is None and rows[6]["n_chars"] == len(rows[6]["text"])


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLES["op2_decontamination"])
    got = op2_decontamination(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
