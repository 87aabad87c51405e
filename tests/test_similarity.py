"""The similarity join against all pairs, with keys made longer and without."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from medallion.operators import reconcile, similarity


def grams(text, q=3):
    return {text[i:i + q] for i in range(max(len(text) - q + 1, 1))}


def all_pairs(left, right, least, q=3):
    out = set()
    for a in set(left) - {None}:
        for b in set(right) - {None}:
            m, n = grams(a, q), grams(b, q)
            o = len(m & n)
            if 100 * o >= least * (len(m | n)):
                out.add((a, b, 100 * o // len(m | n)))
    return out


def table(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text string")


@pytest.mark.parametrize("largest", [1, 100_000])
@pytest.mark.parametrize("least", [30, 60, 85, 100])
def test_against_all_pairs(spark, monkeypatch, least, largest):
    rnd = random.Random(least)
    stems = ["banco do brasil", "banco", "ab", "a", "", "caixa geral de depositos", "aaaaaaaa", "🙂é"]
    monkeypatch.setattr(similarity, "FEW", 0 if largest == 1 else 32)

    def value():
        s = list(rnd.choice(stems) + rnd.choice(["", " s.a.", " sa", "x"]))
        for _ in range(rnd.randrange(0, 3)):
            s.insert(rnd.randrange(len(s) + 1), rnd.choice("abx "))
        return "".join(s)

    left, right = ([value() for _ in range(60)] + [None, None] for _ in range(2))
    got = similarity.similar_pairs(table(spark, left), table(spark, right), least=least, largest=largest).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == all_pairs(left, right, least)


def test_hot_grams_are_split(spark, monkeypatch):
    """All names share a beginning: no group that is joined has more than the largest number of pairs."""
    rnd = random.Random(3)
    names = ["instituto nacional " + "".join(rnd.choice("bcdfglmnprst") for _ in range(12)) for _ in range(400)]
    other = [n[:-1] + "x" if i % 3 else n for i, n in enumerate(names)]
    sizes, met = [], similarity._met
    monkeypatch.setattr(similarity, "FEW", 1)

    def seen(keys, least):
        of = [F.count_if(F.col("side") == i) for i in (0, 1)]
        sizes.append(keys.groupBy("at").agg((of[0] * of[1]).alias("pairs")).agg(F.max("pairs")).first()[0] or 0)
        return met(keys, least)

    monkeypatch.setattr(similarity, "_met", seen)
    got = similarity.similar_pairs(table(spark, names), table(spark, other), least=60, largest=500).collect()
    assert {tuple(r) for r in got} == all_pairs(names, other, 60)
    assert len(sizes) >= 2 and max(sizes) <= 500


def test_few_pairs_are_looked_at(spark):
    """Names with nothing but common q-grams in common are hardly paired with each other."""
    rnd = random.Random(5)
    names = ["companhia geral " + "".join(rnd.choice("bcdfglmnprst") for _ in range(14)) for _ in range(800)]
    left, right = table(spark, names), table(spark, [x + "s" for x in names])
    tokens = similarity._ordered(left.select(F.lit(0).alias("side"), "text").unionByName(right.select(F.lit(1).alias("side"), "text"))
                                 .withColumn("grams", similarity.q_grams(F.col("text"))))
    keys = similarity._by_first(tokens, 80)
    pairs = keys.where("side = 0").select("at").join(keys.where("side = 1").select("at"), "at")
    assert pairs.count() < 0.05 * len(names) ** 2


def test_names_of_the_report(spark):
    claims = spark.createDataFrame([("Bánco Alfa S.A.",), ("BANCO ALFA SA",), ("Banco Beta",), (None,), (" ",), ("Zeta",)], "name string")
    registry = spark.createDataFrame([("Banco Alfa S/A",), ("Banco Beto",), ("Banco Beta",), ("Banco Bet",)], "name string")
    report = reconcile.reconciliation(claims, "name", registry, "name", "claims", "registry")
    got = {tuple(r) for r in similarity.name_proposals(report, "claims", "registry", least=50).collect()}
    assert {(a, b) for a, b, _ in got} == {("Bánco Alfa S.A.", "Banco Alfa S/A"), ("BANCO ALFA SA", "Banco Alfa S/A")}
    best = similarity.name_proposals(report, "claims", "registry", least=10, best=1).collect()
    assert len(best) == len({r["left_name"] for r in best}) and all(r["match_percent"] >= 10 for r in best)
    assert similarity.name_proposals(report.limit(0), "claims", "registry").count() == 0
    with pytest.raises(ValueError):
        similarity.similar_pairs(claims, registry, least=0)


def test_a_common_gram_is_compared_in_blocks(spark, monkeypatch):
    """Blocks of few names, whatever the names of a q-gram, and keys without texts; long texts fill all bits."""
    rnd = random.Random(7)
    names = ["banco " + "".join(rnd.choice("bcdf") for _ in range(9)) for _ in range(150)] + ["".join(map(chr, range(300, 900)))]
    other = [n[:-1] + "x" for n in names]
    sizes, alike = [], similarity._alike
    monkeypatch.setattr(similarity, "CHUNK", 4)

    def seen(block, least):
        sizes.append(len(block["id"]))
        return alike(block, least)

    keys = similarity._by_first(similarity._ordered(table(spark, names).select(F.lit(0).alias("side"), "text").withColumn("grams", similarity.q_grams(F.col("text")))), 45)
    assert not {"text", "tokens"} & set(keys.columns)
    got = similarity.similar_pairs(table(spark, names), table(spark, other), least=45).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == all_pairs(names, other, 45)
    live = keys.unionByName(keys.withColumn("side", F.lit(1))).withColumns({c: F.count_if(F.col("side") == i).over(Window.partitionBy("at")) for i, c in enumerate("lr")})
    monkeypatch.setattr(similarity, "_alike", seen)
    batches = similarity._blocks(live).toArrow().to_batches()
    list(similarity._compare(45)(iter(batches)))
    assert len(sizes) > live.select("at").distinct().count() and 2 * max(sizes) < live.groupBy("at").count().agg(F.max("count")).first()[0]
