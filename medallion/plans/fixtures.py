"""Raw-shaped views of the driver tables.

The reference's own input files (bank registry, complaint files) are not
available, so the three raw sources are dressed up from the driver's TPC-H-like
tables with the same kinds of dirt the real files carry: unpadded and blank
ids, accented / upper-cased / marker-suffixed names, pt-BR decimal text,
ordinal quarters, ``'2000.0'`` years, blank counts, a second profile file with a
different column set, and stale duplicate profiles.  Every view is a lazy
projection (plus one join for claims) over whole tables, so its size grows with
the scale factor.  All raw columns are text, named as in the source files.

The dirt is placed by value (priorities, statuses, months, balances,
segments), never by dropping rows: every customer is an institution and has a profile, every order
is a claim.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import PROFILE_SCORES
from medallion.sources.parquet import read_table


def _s(c: Column) -> Column:
    return c.cast("string")


def _blanks_around(value: Column, where: Column) -> Column:
    return F.when(where, F.concat(F.lit(" "), value, F.lit(" "))).otherwise(value)


def _as_float(value: Column, where: Column) -> Column:
    """Whole numbers as float text (``'12345.0'``), the way a frame with gaps writes them."""
    return F.when(where, F.concat(value, F.lit(".0"))).otherwise(value)


def institutions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank registry: ``Segmento, CNPJ, Nome`` (tab-separated in the wild)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_mktsegment").alias("Segmento"),
        _blanks_around(_s(F.col("c_custkey")), F.col("c_mktsegment") == "BUILDING").alias("CNPJ"),
        F.concat(F.col("c_name"), F.lit(" - PRUDENCIAL")).alias("Nome"),
    )


# Fixed value: a text with every separator of the raw files and with quotes.
REVENUE = 'Desconhecida/não se aplica | "R$ 1; 2"\t'


def _profile_columns(stale: bool) -> list[Column]:
    """The 20 profile columns that precede ``Segmento``/``CNPJ`` in the file."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    scores = []
    for k, (raw, _) in enumerate(PROFILE_SCORES):
        if raw.endswith("(%)"):
            value = F.concat(_s(F.lit(40) + (key + k) % 60), F.lit(".0"))
        else:
            value = F.concat(_s(F.lit(1) + (nation + k) % 5), F.lit("."), _s((key + k) % 10))
        scores.append(value.alias(raw))
    return [
        (F.concat(F.col("c_name"), F.lit(" (old)")) if stale else F.col("c_name")).alias("employer_name"),
        (F.lit("1") if stale else _as_float(_s(nation * 37 + 11), nation % 2 == 1)).alias("reviews_count"),
        _as_float(_s(nation * 13 + 3), nation % 3 == 1).alias("culture_count"),
        _s(nation * 51 + 7).alias("salaries_count"),
        _s(nation * 9 + 1).alias("benefits_count"),
        F.concat(F.lit("http://www."), F.lower(F.col("c_mktsegment")), F.lit(".example.com")).alias("employer-website"),
        F.when(nation % 2 == 0, F.lit("Paris, França")).otherwise(F.lit("São Paulo, Brasil")).alias("employer-headquarters"),
        F.when(nation != 0, F.concat(_s(F.lit(1900) + nation * 4), F.lit(".0"))).alias("employer-founded"),
        F.col("c_mktsegment").alias("employer-industry"),
        F.lit(REVENUE).alias("employer-revenue"),
        F.concat(F.lit("https://example.com/employers/"), _s(key)).alias("url"),
        *scores,
    ]


def profiles_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Employer profiles as two files with different column sets.

    * main file (``Segmento``): one row per customer, segment ``NONE`` for
      customers with a negative balance, plus a stale duplicate (lower
      ``match_percent``) for every AUTOMOBILE customer;
    * second file (``CNPJ`` instead of ``Segmento``): the negative-balance
      customers again, keyed by id.
    """
    c = read_table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_acctbal") < 0, F.lit("NONE")).otherwise(F.col("c_mktsegment")).alias("Segmento")
    name = F.translate(F.col("c_name"), "uo", "úõ").alias("Nome")
    main = c.select(*_profile_columns(stale=False), segment, name, F.lit("100").alias("match_percent"))
    stale = c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(
        *_profile_columns(stale=True), segment, name, F.lit("60").alias("match_percent"))
    less = c.where(F.col("c_acctbal") < 0).select(
        *_profile_columns(stale=False), _blanks_around(_s(F.col("c_custkey")), F.col("c_nationkey") % 2 == 0).alias("CNPJ"), name, F.lit("70").alias("match_percent"))
    return main.unionByName(stale), less


# Order priorities that decide where claim dirt goes.
NO_ID_PRIORITY = "5-LOW"
NO_NAME_PRIORITY = "4-NOT SPECIFIED"
MEDIUM = "3-MEDIUM"

# Raw claim headers that carry the en dash.
CCS_SCR_TOTAL = "Quantidade total de clientes – CCS e SCR"
CCS_COUNT = "Quantidade de clientes – CCS"
SCR_COUNT = "Quantidade de clientes – SCR"


def claims_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly complaints, one per order, with pt-BR text dirt.

    Dirt follows the order's own attributes: low-priority claims come without
    an institution id, unspecified-priority claims without a usable name,
    fulfilled ones with the upper-case conglomerate spelling; December index
    text is blank and June index text is junk; medium-priority claims have
    blank customer counts.  Pending claims have blanks around their id, open ones
    write whole numbers as float text, and the category holds a separator and quotes.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    ckey, nation = F.col("o_custkey"), F.col("c_nationkey")
    day, month = F.dayofmonth("o_orderdate"), F.month("o_orderdate")
    priority = F.col("o_orderpriority")
    blank = F.lit(" ")
    ccs_blank = priority == MEDIUM
    floats = F.col("o_orderstatus") == "O"
    return j.select(
        _s(F.year("o_orderdate")).alias("Ano"),
        F.concat(_s(F.quarter("o_orderdate")), F.lit("º")).alias("Trimestre"),
        F.concat(priority, F.lit('; "'), F.col("o_orderstatus"), F.lit('"')).alias("Categoria"),
        F.col("o_orderstatus").alias("Tipo"),
        F.when(priority == NO_ID_PRIORITY, blank).otherwise(_blanks_around(_s(ckey), F.col("o_orderstatus") == "P")).alias("CNPJ IF"),
        F.when(priority == NO_NAME_PRIORITY, F.lit("SEM NOME"))
         .when(F.col("o_orderstatus") == "F", F.concat(F.upper("c_name"), F.lit(" (conglomerado)")))
         .otherwise(F.concat(blank, F.col("c_name"))).alias("Instituição financeira"),
        F.when(month == 12, blank)
         .when(month == 6, F.lit("n/d"))
         .otherwise(F.translate(F.format_number("o_totalprice", 2), ",.", ".,")).alias("Índice"),
        _as_float(_s(nation), floats).alias("Quantidade de reclamações reguladas procedentes"),
        _s(day).alias("Quantidade de reclamações reguladas - outras"),
        _s(month).alias("Quantidade de reclamações não reguladas"),
        _s(nation + day + month).alias("Quantidade total de reclamações"),
        F.when(ccs_blank, blank).otherwise(_as_float(_s(ckey * 3), floats)).alias(CCS_SCR_TOTAL),
        F.when(ccs_blank, blank).otherwise(_as_float(_s(ckey * 2), floats)).alias(CCS_COUNT),
        F.when(ccs_blank, blank).otherwise(_as_float(_s(ckey), floats)).alias(SCR_COUNT),
    )


def _word(first: int, length: int) -> Column:
    """A made-up word that follows from the customer's key."""
    return F.translate(F.substring(F.md5(_s(F.col("c_custkey"))), first, length), "0123456789abcdef", "bcdfglmnprstaeio")


def spelled_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One institution name a customer as the registry and as the claims spell it.

    All names share their first word.  The claims' spelling follows the nation: the same but for
    case and accents, a wrong letter, the second word missing, another short form, or a suffix.
    """
    c = read_table(spark, sf_dir, "customer")
    one, two, kind = F.initcap(_word(1, 8)), F.initcap(_word(9, 10)), F.col("c_nationkey") % 5
    registry = F.concat(F.lit("Banco "), one, F.lit(" "), two, F.lit(" S.A."))
    claims = (F.when(kind == 0, F.concat(F.lit("BÁNCO "), F.upper(one), F.lit(" "), F.upper(two), F.lit(" S.A.")))
              .when(kind == 1, F.concat(F.lit("Banco "), one, F.lit(" "), F.overlay(two, F.lit("x"), F.lit(5)), F.lit(" S.A.")))
              .when(kind == 2, F.concat(F.lit("Banco "), one, F.lit(" S.A.")))
              .when(kind == 3, F.concat(F.lit("Bco "), one, F.lit(" "), two))
              .otherwise(F.concat(F.lit("Banco "), one, F.lit(" "), two, F.lit(" S.A. Múltiplo"))))
    return c.select(claims.alias("name")), c.select(registry.alias("name"))


# The letters of made-up words in three scripts; c stands for a sound that takes two Latin letters.
WORD_LETTERS = "bcdfglmnprstaeio"
CYRILLIC_LETTERS = "бцдфглмнпрстаеио"
GREEK_LETTERS = "βχδφγλμνπρστάεϊό"


def scripts_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made-up name a customer in Latin letters (as Cyrillic and as Greek is read), in Cyrillic and in Greek."""
    c = read_table(spark, sf_dir, "customer")
    name = F.concat(_word(1, 8), F.lit(" "), _word(9, 10))
    return c.select(
        "c_custkey", F.initcap(F.replace(name, F.lit("c"), F.lit("ts"))).alias("as_cyrillic"),
        F.replace(F.replace(name, F.lit("c"), F.lit("ch")), F.lit("f"), F.lit("ph")).alias("as_greek"),
        F.initcap(F.translate(name, WORD_LETTERS, CYRILLIC_LETTERS)).alias("cyrillic"),
        F.translate(name, WORD_LETTERS, GREEK_LETTERS).alias("greek"))
