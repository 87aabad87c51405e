"""Contracts: declared types and rules, cleaning of counts, ids and names, and the SQL surface's agreement."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.contracts import CLAIMS, DELIVERY, INSTITUTIONS, PROFILES
from medallion.functions import casts, text
from medallion.functions.keys import name_key, name_norm
from medallion.functions.unaccent import unaccent
from medallion.operators.quality import contract_violations
from medallion.plans.layers import trusted_claims
from medallion.plans.sqlapi import register_sql_functions
from medallion.sinks.jdbc import contract_column_types, create_table_column_types
from medallion.sinks.parquet import publish_table, write_parquet


def results(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("contract", [INSTITUTIONS, PROFILES, CLAIMS, DELIVERY], ids=lambda c: c.name)
def test_column_types_parse(spark, contract):
    for decimals in (True, False):
        parsed = T.StructType.fromDDL(create_table_column_types(contract_column_types(contract, decimals)))
        assert parsed.names == contract.names


def test_declared_decimals_and_null_rules():
    types = contract_column_types(DELIVERY)
    assert types["general_score"] == types["match_percent"] == "DECIMAL(5, 2)" and types["bank_index"] == "DOUBLE"
    assert not DELIVERY.field("year_claim").nullable and not DELIVERY.field("financial_institution_name").nullable
    assert CLAIMS.primary_key == ("financial_institution_name", "year_claim", "quarter_claim")


def test_whole_numbers_of_the_full_range(spark):
    values = ["9210000000000000000", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "15.0", " 7.9 ", "-9223372036854775808.0",
              "1e19", "NaN", "x", " ", None]
    want = [9210000000000000000, 2**63 - 1, -(2**63), None, 15, 7, -(2**63), None, None, None, None, None]
    assert results(spark, casts.float_text_to_long, values) == want
    values = ["-2147483648", "-2147483648.5", "-2147483649", "2147483647.9", "2147483648.0", "2147483648", "12.0"]
    assert results(spark, casts.float_text_to_int, values) == [-(2**31), -(2**31), None, 2**31 - 1, None, None, 12]


def test_replace_first_keeps_the_rest(spark):
    assert results(spark, lambda c: text.regex_replace_first(c, "b", "-"), ["abcb" + "x" * 50, "b", "a", ""]) == ["a-cb" + "x" * 50, "-", "a", ""]


def claim(spark, **values):
    row = {name: None for name in CLAIMS.raw_names} | values
    return trusted_claims(spark.createDataFrame([tuple(row.values())], ", ".join(f"`{n}` string" for n in row))).first()


def test_claims_are_cleaned_before_they_are_typed(spark):
    r = claim(spark, **{"CNPJ IF": " 123 ", "Instituição financeira": "BB (conglomerado) ", "Trimestre": "4º",
                        "Quantidade de reclamações reguladas - outras": "7.0", "Quantidade de clientes – CCS": "12345.0",
                        "Quantidade de clientes – SCR": " "})
    assert r["cnpj"] == "00000123" and r["financial_institution_name"] == "BANCO DO BRASIL"
    assert r["number_of_regulated_other_complaints"] == 7 and r["number_of_ccs_customers"] == 12345 and r["number_of_scr_customers"] is None
    assert claim(spark, **{"CNPJ IF": "\xa0"})["cnpj"] is None


def test_one_key_for_every_spelling(spark):
    spellings = ["BANCO ITAÚ", "BANCO\xa0ITAÚ", "BANCO ITAÚ", "banco itau", " Banco Itaú ", "BANCO ITAỤ"]
    assert len(set(results(spark, name_key, spellings))) == 1
    assert len(set(results(spark, name_key, ["A – B", "A - B", "A‑B", "a-b"]))) == 1
    assert results(spark, name_norm, ["VIỆT", "Ẽ", "D’Or", "“x”"]) == ["viet", "e", "d'or", '"x"']


SHARED = [None, "", " ", "\xa0", " 123 ", "1 2", "123456789", "1.234,56", "1d", "2F", "nan", "NaN", "Infinity", " 7 ", "1e5", "São  Paulo", "BANCO – X",
          "4º", "A (conglomerado)", "B - PRUDENCIAL", "C (- PRUDENCIAL)", "é̂", "ỆỪ", "Straße", "\tx\n"]


@pytest.mark.parametrize("name, column", [
    ("md_unaccent", unaccent), ("md_name_norm", name_norm), ("md_name_key", name_key), ("md_blank_to_null", text.blank_to_null), ("md_pad_id", text.pad_id),
    ("md_locale_decimal", text.locale_decimal), ("md_strip_conglomerate", text.strip_conglomerate), ("md_strip_prudential", text.strip_prudential),
    ("md_drop_ordinal", text.drop_ordinal)])
def test_sql_cleaners_equal_column_cleaners(spark, name, column):
    assert name in register_sql_functions(spark)
    by_sql, by_column = (list(map(repr, results(spark, f, SHARED))) for f in (lambda c: F.expr(f"{name}(v)"), column))
    assert by_sql == by_column


def test_rules(spark):
    df = spark.createDataFrame([(None, "x", 1234.5), ("1" * 5, "3", 999.994), ("2020", " ", None)], "year_claim string, quarter_claim string, general_score double")
    got = {(r["column_name"], r["rule"]): r["violations"] for r in contract_violations(df, DELIVERY).collect()}
    assert got[("year_claim", "not_null")] == got[("year_claim", "max_length")] == 1
    assert got[("quarter_claim", "not_null")] == 0 and got[("quarter_claim", "numeric")] == 1
    assert got[("general_score", "numeric")] == 1


def test_catalog_table_has_the_contract_types(spark, tmp_path):
    df = spark.range(1).select(*[F.lit(None).cast({"string": "string"}.get(f.dtype, f.dtype)).alias(f.name) for f in DELIVERY.fields])
    out = publish_table(spark, df, "contract_types_t", str(tmp_path / "t"), DELIVERY)
    try:
        rows = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE contract_types_t").collect()}
        assert rows["year_claim"] == "varchar(4)" and rows["bank_index"] == "double" and rows["match_percent"] == "int"
        assert out.count() == 1
    finally:
        spark.sql("DROP TABLE contract_types_t")


def test_partitioned_write_has_few_files(spark, tmp_path):
    df = spark.range(20_000, numPartitions=16).select("id", (F.col("id") % 7).cast("string").alias("year"))
    write_parquet(df, str(tmp_path / "t"), partition_by=["year"])
    assert len(list((tmp_path / "t").glob("year=*/*.parquet"))) <= 14  # 16 tasks x 7 years without clustering
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000
