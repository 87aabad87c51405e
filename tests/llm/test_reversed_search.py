import math
import re
from collections import Counter

import pytest

from medallion.llm import reversed_search
from medallion.llm.queries import OP13_SQL, op13_reversed_search

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=20):
    """(item id, rank, id, score) by the formula, one pair at a time."""
    counted = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    big_n, big_l = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, c, n in counted:
            m = 75 + 25 * n * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in TERM.findall((text or "").translate(UPPER)) if c[t])
            if s > 0:
                scored.append((-s, doc is None, 0 if doc is None else doc, doc))
        rows += [(item, k, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return rows


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_against_sql(spark, duck):
    got = op13_reversed_search(spark, SF)
    want = duck.sql(OP13_SQL)
    assert got.columns == want.columns
    assert ordered(got.collect()) == ordered(want.fetchall())


@pytest.mark.parametrize("block_terms", [1, 60, 1 << 17])
def test_blocks_of_items_change_nothing(spark, documents, document_rows, block_terms):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(9)
    rows = items.collect()
    got = reversed_search.search(documents, spark.createDataFrame(rows, items.schema), top=3, block_terms=block_terms).collect()
    want = brute([(r["doc_id"], r["text"]) for r in document_rows], [(r["item_id"], r["text"]) for r in rows], top=3)
    assert ordered(got) == ordered(want)


def test_odd_documents_and_items(spark, odd_docs):
    items = [(1, "the quick fox, the FOX"), (2, None), (3, ""), (3, "été don 🙂"), (None, "und lazy"), (4, "..."), (5, "absent"), (6, "word1 " * 40_000 + "the")]
    table = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id bigint, text string, score string, doc string")
    got = reversed_search.search(odd_docs, table).collect()
    assert ordered(got) == ordered(brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], items))


def test_ties_go_to_the_smallest_ids(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(200, 0, -1)] + [(0, "other")], "doc_id bigint, text string").repartition(7)
    items = spark.createDataFrame([("a", "words")], "item_id string, text string")
    got = reversed_search.search(docs, items).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(1, 21)) and [r["rank"] for r in got] == list(range(1, 21))


def test_string_ids_and_very_long_text(spark):
    long = "alpha beta " * 150_000
    docs = spark.createDataFrame([("b", long), ("a", "alpha"), ("c", "gamma")], "doc_id string, text string")
    items = [("q", "alpha beta")]
    got = reversed_search.search(docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    assert ordered(got) == ordered(brute([tuple(r) for r in docs.collect()], items)) and len(got) == 2


def test_no_rows(spark, no_docs, odd_docs):
    items = spark.createDataFrame([(1, "the")], "item_id bigint, text string")
    assert reversed_search.search(no_docs, items).count() == 0
    got = reversed_search.search(odd_docs, items.limit(0))
    assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]
