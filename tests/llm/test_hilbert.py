import itertools
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from medallion.llm import hilbert
from medallion.llm.queries import op6_hilbert_shards

from .conftest import SF


@pytest.mark.parametrize("d, bits", [(1, 4), (2, 4), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(d, bits):
    digit, following = hilbert.transitions(d)
    points = {}
    for cell in itertools.product(range(1 << bits), repeat=d):
        state = index = 0
        for level in reversed(range(bits)):
            at = state * (1 << d) + sum((c >> level & 1) << i for i, c in enumerate(cell))
            index, state = index << d | digit[at], following[at]
        points[index] = cell
    assert sorted(points) == list(range(1 << d * bits))
    assert all(sum(abs(a - b) for a, b in zip(points[i], points[i + 1])) == 1 for i in range(len(points) - 1))


def test_index_column(spark):
    digit, following = hilbert.transitions(3)
    cells = [(a, b, c) for a in range(4) for b in range(4) for c in range(4)]
    rows = spark.createDataFrame(cells, "a int, b int, c int").withColumn("i", hilbert.curve_index([F.col("a"), F.col("b"), F.col("c")], 2)).collect()
    for r in rows:
        state = index = 0
        for level in (1, 0):
            at = state * 8 + sum((r[n] >> level & 1) << k for k, n in enumerate("abc"))
            index, state = index << 3 | digit[at], following[at]
        assert r["i"] == index


def laws(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    counts = Counter({s: len(v) for s, v in slots.items()})
    sizes = [counts[s] for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query(spark, document_rows):
    rows = op6_hilbert_shards(spark, SF).collect()
    laws(rows, 40)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in document_rows}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t) + 16, zlib.crc32(t)) for i, t in texts.items()}
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_plan_is_native(spark):
    plan = op6_hilbert_shards(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_odd_rows(odd_docs, no_docs, shards):
    rows = hilbert.assign_shards(odd_docs, shards).collect()
    assert len(rows) == 11
    laws(rows, shards)
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes[2] == sizes[3] == 16 and sizes[4] == 20
    assert hilbert.assign_shards(no_docs, shards).count() == 0


def test_shards_prune_in_several_dimensions(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") * 7919 % 4000).cast("int")).alias("text"),
                                    F.lit("s").alias("source"), F.lit("en").alias("lang"))
    bounds = hilbert.shard_bounds(hilbert.assign_shards(docs, 16), ["doc_id", "size"]).collect()
    assert sum(r["rows"] for r in bounds) == 4000
    # a narrow filter on either dimension leaves out most shards
    assert sum(r["min_doc_id"] <= 100 and r["max_doc_id"] >= 50 for r in bounds) <= 8
    assert sum(r["min_size"] <= 60 for r in bounds) <= 8


def test_shards_prune_by_labels(spark):
    """With 500 sources, the bounds of most shards leave a given source out, and all shards that hold it have it within theirs."""
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") * 7919 % 4000).cast("int")).alias("text"),
                                    F.when(F.col("id") % 977 != 5, F.format_string("source %03d", F.col("id") * 31 % 500)).alias("source"),
                                    F.element_at(F.array(*map(F.lit, ("de", "en", "fr"))), (F.col("id") % 3 + 1).cast("int")).alias("lang"))
    shards = hilbert.assign_shards(docs, 16).join(docs.select("doc_id", "source", "lang"), "doc_id")
    bounds = hilbert.shard_bounds(shards, ["source", "lang"]).collect()
    holding = {}
    for r in shards.where("source is not null").select("source", "shard").distinct().collect():
        holding.setdefault(r["source"], set()).add(r["shard"])
    covering = {s: {r["shard"] for r in bounds if r["min_source"] <= s <= r["max_source"]} for s in holding}
    assert all(holding[s] <= covering[s] for s in holding)
    assert sum(map(len, covering.values())) / len(covering) <= 9
    assert sum(r["min_lang"] <= "fr" <= r["max_lang"] for r in bounds) <= 12
