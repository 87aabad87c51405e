"""Unit tests per cleaner on literal rows, including the FIXTURES edge cases."""

from pyspark.sql import functions as F

from medallion.functions import casts, text
from medallion.functions.keys import document_key, name_key, name_norm
from medallion.functions.unaccent import unaccent, unaccent_nfkd


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_pad_id_edges(spark):
    assert one(spark, text.pad_id, "123") == "00000123"
    assert one(spark, text.pad_id, "123456789") == "123456789"      # never truncates (D2)
    assert one(spark, text.pad_id, " ") is None                       # blank -> null (D1)
    assert one(spark, text.pad_id, "") is None
    assert one(spark, text.pad_id, None) is None
    assert one(spark, text.pad_truncate, "123456789") == "12345678"   # T2 truncates


def test_locale_decimal(spark):
    assert one(spark, text.locale_decimal, "1.234.567,89") == 1234567.89
    assert one(spark, text.locale_decimal, " ") is None
    assert one(spark, text.locale_decimal, "x") is None


def test_quarter_and_year(spark):
    assert one(spark, lambda c: casts.to_int(text.drop_ordinal(c)), "4º") == 4
    assert one(spark, lambda c: casts.to_int(text.cut_decimals(c)), "1808.0") == 1808
    assert one(spark, lambda c: casts.to_int(text.cut_decimals(c)), "") is None
    assert one(spark, casts.float_text_to_long, "2000.0") == 2000
    assert one(spark, casts.float_text_to_long, "1e30") is None


def test_name_key_spellings_agree(spark):
    df = spark.createDataFrame([("  Itaú ",), ("ITAU",), ("Itau (conglomerado)",)], "v string")
    keys = {r["k"] for r in df.select(name_key(text.strip_conglomerate("v")).alias("k")).collect()}
    assert len(keys) == 1
    assert one(spark, name_norm, "São  Paulo\tBank") == "saopaulobank"


def test_alias_whole_value_not_substring(spark):
    m = {"BB": "BANCO DO BRASIL"}
    assert one(spark, lambda c: text.alias_map(c, m), "BB") == "BANCO DO BRASIL"
    assert one(spark, lambda c: text.alias_map(c, m), "BBX") == "BBX"
    assert one(spark, lambda c: text.alias_substring(c, m), "BBX") == "BANCO DO BRASILX"


def test_headquarters_split(spark):
    assert one(spark, lambda c: text.split_part_trim(c, ",", 1), "Paris, França") == "Paris"
    assert one(spark, lambda c: text.split_part_trim(c, ",", -1), "Paris, França") == "França"


def test_markers(spark):
    assert one(spark, text.strip_prudential, "BANCO X - PRUDENCIAL") == "BANCO X"
    assert one(spark, text.strip_prudential, "BANCO X (- PRUDENCIAL)") == "BANCO X"
    assert one(spark, text.strip_conglomerate, "ITAU (conglomerado)") == "ITAU"


def test_unaccent_native_and_udf_agree(spark):
    samples = ["Ação São Paulo", "Straße Øre Æble", "crème brûlée", "Łódź", None]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    rows = df.select(unaccent("v").alias("a"), unaccent_nfkd("v").alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]
    assert rows[0]["a"] == "Acao Sao Paulo"
    assert rows[1]["a"] == "Strasse Ore AEble"


def test_document_key_null_part(spark):
    df = spark.createDataFrame([("00000001", "S1"), (None, "S1")], "a string, b string")
    out = df.select(document_key("a", "b").alias("k"), document_key("a", "b", "md5").alias("m")).collect()
    assert len(out[0]["k"]) == 40 and len(out[0]["m"]) == 32
    assert out[1]["k"] is None


def test_cleaners_idempotent(spark):
    for fn, v in [(text.pad_id, "12"), (text.strip, "  a  "), (unaccent, "Ação"), (name_norm, "A b")]:
        once = one(spark, fn, v)
        assert one(spark, fn, once) == once


def test_regex_replace_first(spark):
    first = lambda c: text.regex_replace_first(c, r"\.", "")
    assert one(spark, first, "1.234.567,89") == "1234.567,89"
    assert one(spark, first, ".5") == "5"
    assert one(spark, first, "no dots") == "no dots"
    assert one(spark, first, None) is None


def test_reconciliation_both_sides(spark):
    from medallion.operators.reconcile import reconciliation
    claims = spark.createDataFrame([("Itaú (conglomerado)",), ("ITAU",), ("SEM NOME",), (" ",), (None,)], "n string")
    profiles = spark.createDataFrame([("Itau",), ("Banco Beta",), ("banco  beta",)], "n string")
    got = sorted((r["side"], r["name"], r["name_norm"])
                 for r in reconciliation(claims, "n", profiles, "n", "claims", "profiles").collect())
    assert got == [("claims", "SEM NOME", "semnome"),
                   ("profiles", "Banco Beta", "bancobeta"), ("profiles", "banco  beta", "bancobeta")]


def test_greek_and_cyrillic_names_have_the_keys_of_latin_ones(spark):
    from medallion.functions.keys import name_key
    from medallion.functions.unaccent import unaccent, unaccent_nfkd

    pairs = [("Банк Москвы", "Bank Moskvy"), ("СБЕРБАНК РОССИИ", "sberbank rossii"), ("Альфа-Банк", "alfa-bank"), ("Жёлтый щит", "Zhyoltyy shchit"),
             ("Київ", "Kiyiv"), ("Хоум Кредит", "Khoum Kredit"), ("Εθνική Τράπεζα", "ethnike trapeza"), ("ΨΥΧΉ", "psuche"), ("Jožin из б", "jozin iz b")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", name_key("a").alias("x"), name_key("b").alias("y"), unaccent("a").alias("native"), unaccent_nfkd("a").alias("udf")).collect()
    assert [(r["a"], r["native"]) for r in rows if r["x"] != r["y"]] == []
    assert all(r["native"] == r["udf"] and r["native"].isascii() for r in rows)


def test_marks_apart_from_their_letters(spark):
    import unicodedata

    from medallion.functions.unaccent import unaccent, unaccent_nfkd

    texts = ["Йод ёж їжак", "Ά έ ύ ώ", "Žluťoučký", "нет", "中文 ok", "", None]
    df = spark.createDataFrame([(t, t and unicodedata.normalize("NFD", t)) for t in texts], "a string, b string")
    for r in df.select(unaccent("a").alias("a"), unaccent("b").alias("b"), unaccent_nfkd("a").alias("c"), unaccent_nfkd("b").alias("d")).collect():
        assert r["a"] == r["b"] == r["c"] == r["d"]
    assert df.select(unaccent("a").alias("a")).first()["a"] == "Yod yozh yizhak"
