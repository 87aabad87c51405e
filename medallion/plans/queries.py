"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) in
full; none is restricted to a subset of ids or rows.  Queries that exercise a
sink write their input to a fresh folder below the shared checkpoint root and
return the lazy read-back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import CLAIM_COLUMNS, CLAIMS, DELIVERY, DELIVERY_COLUMNS, INSTITUTIONS, PROFILES
from medallion.functions import casts, text
from medallion.functions.keys import document_key, md5_hex, name_key, sha1_hex
from medallion.functions.unaccent import unaccent, unaccent_nfkd
from medallion.operators import dedup, joins, quality, reconcile, similarity
from medallion.operators.project import column_difference, keep_only, rename_columns
from medallion.operators.union import union_by_name
from medallion.plans import fixtures, incremental
from medallion.plans.layers import (
    build_raw,
    composite_key_join,
    delivery_matches,
    delivery_satisfaction,
    employees_of,
    run_pipeline,
    trusted_claims,
    trusted_institutions,
    trusted_profiles,
)
from medallion.plans.sqlapi import delivery_satisfaction_sql, register_sql_functions, register_views
from medallion.session import scratch_path
from medallion.sinks.bucketed import join_stored, write_joinable
from medallion.sinks.delimited import write_delimited
from medallion.sinks.batches import batch_counts, read_batches, write_batch
from medallion.sinks.parquet import publish_table, replace_periods, sql_copy_parquet, write_parquet
from medallion.sources import charset, delimited
from medallion.sources.parquet import read_table, register_scan, sql_scan
from medallion.streaming.ingest import run_once

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _view_name(base: str) -> str:
    """A session-unique temporary view name (queries may run side by side)."""
    return f"{base}_{uuid.uuid4().hex[:8]}"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# --------------------------------------------------------------------------
# Layers
# --------------------------------------------------------------------------

def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both profile files, unioned by name, with the file each row came from."""
    main, second = fixtures.profiles_raw(spark, sf_dir)
    return union_by_name(
        main.withColumn("source_file", F.lit("profiles_main")),
        second.withColumn("source_file", F.lit("profiles_second")),
    )


@query("trusted_institutions")
def q_trusted_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_institutions(fixtures.institutions_raw(spark, sf_dir))


@query("trusted_profiles")
def q_trusted_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_profiles(raw_profiles(spark, sf_dir))


@query("trusted_claims")
def q_trusted_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_claims(fixtures.claims_raw(spark, sf_dir))


@query("delivery_satisfaction")
def q_delivery_satisfaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (Z5): raw-shaped sources -> trusted -> delivery."""
    return delivery_satisfaction(
        q_trusted_claims(spark, sf_dir),
        q_trusted_institutions(spark, sf_dir),
        q_trusted_profiles(spark, sf_dir),
    )


# --------------------------------------------------------------------------
# Scalar cleaners, casts, hashes and keys
# --------------------------------------------------------------------------


# Fixed values used by the mapping queries.
SEGMENT_ALIASES = {"AUTOMOBILE": "AUTO", "BUILDING": "CONSTRUCTION", "BB": "BANCO DO BRASIL"}
TYPE_SUBSTRINGS = {"BRASS": "LATÃO", "STEEL": "AÇO", "PROMO": "PROMOÇÃO"}


@query("pad_id")
def q_pad_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 vs T2 on short ids and on ids longer than eight digits."""
    c = read_table(spark, sf_dir, "customer")
    short = F.col("c_custkey").cast("string")
    long = (F.col("c_custkey") * 100003).cast("string")
    return c.select(
        "c_custkey",
        text.pad_id(short).alias("id_padded"),
        text.pad_truncate(short).alias("id_lpad"),
        text.pad_id(long).alias("long_padded"),
        text.pad_truncate(long).alias("long_lpad"),
    )


@query("locale_decimal")
def q_locale_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pt-BR price text (with blanks and junk) back to a double."""
    o = read_table(spark, sf_dir, "orders")
    month = F.month("o_orderdate")
    raw = (F.when(month == 12, F.lit(" "))
           .when(month == 6, F.lit("n/d"))
           .otherwise(F.translate(F.format_number("o_totalprice", 2), ",.", ".,")))
    return o.select("o_orderkey", text.locale_decimal(raw).alias("price"))


@query("quarter_ordinal")
def q_quarter_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T12 + C2: ``'3º'`` -> 3."""
    o = read_table(spark, sf_dir, "orders")
    raw = F.concat(F.quarter("o_orderdate").cast("string"), F.lit("º"))
    return o.select("o_orderkey", casts.to_int(text.drop_ordinal(raw)).alias("quarter_claim"))


@query("founded_year")
def q_founded_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13 + C3: ``'1904.0'`` -> 1904 by cutting decimals and by way of double."""
    c = read_table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    raw = F.when(nation != 0, F.concat((F.lit(1900) + nation * 4).cast("string"), F.lit(".0")))
    return c.select(
        "c_custkey",
        casts.to_int(text.cut_decimals(raw)).alias("founded_cut"),
        casts.float_text_to_long(raw).alias("founded_via_double"),
    )


@query("cast_map")
def q_cast_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text copy of lineitem typed back in one projection."""
    li = read_table(spark, sf_dir, "lineitem")
    as_text = li.select(*[F.col(c).cast("string").alias(c) for c in li.columns])
    return casts.cast_map(as_text, {c: t for c, t in li.dtypes if t != "string"})


@query("unaccent_documents")
def q_unaccent_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T14 over whole document texts (native translate)."""
    d = read_table(spark, sf_dir, "documents")
    folded = unaccent(F.col("text"))
    return d.select("doc_id", sha1_hex(folded).alias("text_sha1"), F.length(folded).alias("n_chars_folded"))


@query("name_key_scripts")
def q_name_key_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key for a name in Latin, Cyrillic and Greek letters."""
    names = fixtures.scripts_names(spark, sf_dir)
    return names.select("c_custkey", *(name_key(c).alias(f"{c}_key") for c in ("as_cyrillic", "cyrillic", "as_greek", "greek")),
                        unaccent("cyrillic").alias("cyrillic_in_latin"))


@query("unaccent_udf")
def q_unaccent_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Arrow-batched NFKD path over the same texts."""
    d = read_table(spark, sf_dir, "documents")
    folded = unaccent_nfkd(F.col("text"))
    return d.select("doc_id", sha1_hex(folded).alias("text_sha1"), F.length(folded).alias("n_chars_folded"))


@query("strip_markers")
def q_strip_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix markers removed in all their spellings."""
    c = read_table(spark, sf_dir, "customer")
    name = F.col("c_name")
    return c.select(
        "c_custkey",
        text.strip_conglomerate(F.concat(name, F.lit(" (conglomerado)"))).alias("claim_name"),
        text.strip_prudential(F.concat(name, F.lit(" - PRUDENCIAL"))).alias("registry_name"),
        text.strip_prudential(F.concat(name, F.lit(" (- PRUDENCIAL)"))).alias("registry_name_paren"),
    )


@query("split_parts")
def q_split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL host and first path segment by ``split_part``."""
    p = read_table(spark, sf_dir, "pages")
    return p.select(
        "page_id",
        text.split_part_trim("url", "/", 3).alias("host"),
        text.split_part_trim("url", "/", 4).alias("lang"),
        text.split_part_trim("url", "/", 1).alias("scheme"),
    )


@query("text_normalise")
def q_text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3-T7, T9, T15 on padded, tabbed names."""
    c = read_table(spark, sf_dir, "customer")
    messy = F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t"), F.col("c_mktsegment"), F.lit(" "))
    return c.select(
        "c_custkey",
        text.lower(messy).alias("lowered"),
        text.strip(messy).alias("stripped"),
        text.remove_spaces(messy).alias("no_spaces"),
        text.remove_whitespace(messy).alias("no_whitespace"),
        text.regex_replace_all("c_name", "#0+", "#").alias("short_name"),
        text.literal_replace("c_name", "Customer", "Cliente").alias("renamed"),
        text.concat_text("c_mktsegment", F.lit("/"), "c_name").alias("joined"),
    )


@query("regex_replace_first")
def q_regex_replace_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T8 vs T7 on dotted text: first match only against every match."""
    c = read_table(spark, sf_dir, "customer")
    dotted = F.concat_ws(".", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string"))
    return c.select(
        "c_custkey",
        text.regex_replace_first(dotted, r"\.", "").alias("first_dot_removed"),
        text.regex_replace_all(dotted, r"\.", "").alias("all_dots_removed"),
        text.regex_replace_first(dotted, "#0+", "#").alias("short_name"),
    )


@query("alias_map")
def q_alias_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-value aliases; other values pass through."""
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", text.alias_map("c_mktsegment", SEGMENT_ALIASES).alias("segment"))


@query("alias_substring")
def q_alias_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successive substring replacements."""
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", text.alias_substring("p_type", TYPE_SUBSTRINGS).alias("p_type_pt"))


@query("blank_to_null")
def q_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T19 + C2: blank count text -> null, then bigint."""
    o = read_table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(" ")).otherwise((F.col("o_custkey") * 2).cast("string"))
    return o.select("o_orderkey", text.blank_to_null(raw).alias("ccs_text"),
                    casts.to_long(text.remove_spaces(raw)).alias("ccs_customers"))


@query("conditional_value")
def q_conditional_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CASE WHEN."""
    o = read_table(spark, sf_dir, "orders")
    band = (F.when(F.col("o_totalprice") >= 300000, F.lit("high"))
            .when(F.col("o_totalprice") >= 100000, F.lit("mid"))
            .otherwise(F.lit("low")))
    return o.select("o_orderkey", band.alias("price_band"))


@query("sha1_key")
def q_sha1_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1."""
    return read_table(spark, sf_dir, "customer").select("c_custkey", sha1_hex("c_name").alias("name_sha1"))


@query("md5_key")
def q_md5_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2."""
    return read_table(spark, sf_dir, "customer").select("c_custkey", md5_hex("c_name").alias("name_md5"))


@query("name_key")
def q_name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry, profile and claim spellings of one name give one key."""
    c = read_table(spark, sf_dir, "customer")
    name = F.col("c_name")
    return c.select(
        "c_custkey",
        name_key(text.strip_prudential(F.concat(name, F.lit(" - PRUDENCIAL")))).alias("registry_key"),
        name_key(F.translate(name, "uo", "úõ")).alias("profile_key"),
        name_key(text.strip_conglomerate(F.concat(F.lit(" "), F.upper(name), F.lit(" (conglomerado)"))))
        .alias("claim_key"),
        name_key(F.concat(F.lit("\xa0"), name, F.lit("\u2009"))).alias("no_break_key"),
        name_key(F.replace(F.replace(name, F.lit("o"), F.lit("o\u0301")), F.lit("e"), F.lit("e\u0323\u0302"))).alias("decomposed_key"),
        name_key(F.translate(name, "uoe", "ừộệ")).alias("extended_key"),
        name_key(F.replace(name, F.lit("#"), F.lit("-"))).alias("dashed_key"),
        name_key(F.replace(name, F.lit("#"), F.lit("–"))).alias("en_dashed_key"),
    )


@query("document_key")
def q_document_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y2 in both hash flavours (the reference uses SHA-1 and, in its SQL variant, MD5)."""
    c = read_table(spark, sf_dir, "customer")
    cnpj = text.pad_id(F.col("c_custkey").cast("string"))
    return c.select(
        "c_custkey",
        document_key(cnpj, "c_mktsegment").alias("sk_sha1"),
        document_key(cnpj, "c_mktsegment", algo="md5").alias("sk_md5"),
    )


# --------------------------------------------------------------------------
# Joins, de-duplication, windows, unions, limits
# --------------------------------------------------------------------------


@query("join_id")
def q_join_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with their registry entry by 8-digit id (USING-style key)."""
    banks = q_trusted_institutions(spark, sf_dir).drop("financial_institution_name")
    return joins.join_on(q_trusted_claims(spark, sf_dir), banks, "cnpj")


@query("join_name_key")
def q_join_name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with every profile of the same name key."""
    prof = q_trusted_profiles(spark, sf_dir).select(
        "sk_financial_institution_name", "employer_name", "segment", "match_percent", "source_file")
    return joins.join_on_key(q_trusted_claims(spark, sf_dir), prof, "sk_financial_institution_name", source="financial_institution_name")


@query("delivery_bucketed")
def q_delivery_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/J3/Z5 on stored tables: claims and matches in the same buckets of the id, joined without an exchange."""
    claims = q_trusted_claims(spark, sf_dir).select(*CLAIM_COLUMNS)
    matches = delivery_matches(q_trusted_institutions(spark, sf_dir), employees_of(claims, q_trusted_profiles(spark, sf_dir)))
    name = _view_name("delivery")
    stored = write_joinable(spark, scratch_path(spark, name), name, claims, matches, "cnpj", buckets=16)
    out = join_stored(*stored, "cnpj", DELIVERY_COLUMNS, distinct=True)
    for kind in ("large", "small"):  # the plan has its files and buckets: nothing is left in the catalog
        spark.sql(f"DROP TABLE {name}_{kind}")
    return out


@query("join_composite")
def q_join_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composite-key join itself, duplicates of the output kept."""
    return composite_key_join(
        q_trusted_claims(spark, sf_dir),
        q_trusted_institutions(spark, sf_dir),
        q_trusted_profiles(spark, sf_dir),
    )


@query("delivery_satisfaction_late")
def q_delivery_satisfaction_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with the reference's placement of the distinct: on the joined output."""
    return delivery_satisfaction(
        q_trusted_claims(spark, sf_dir),
        q_trusted_institutions(spark, sf_dir),
        q_trusted_profiles(spark, sf_dir),
        early_distinct=False,
    )


@query("delivery_satisfaction_sql")
def q_delivery_satisfaction_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL variant -- three-way join on id and on name key, 29 columns."""
    return delivery_satisfaction_sql(
        spark,
        q_trusted_claims(spark, sf_dir),
        q_trusted_institutions(spark, sf_dir),
        q_trusted_profiles(spark, sf_dir),
    )


@query("anti_both_ways")
def q_anti_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label row and label rows without a document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    only_docs, only_labels = joins.anti_both_ways(docs, labels, "doc_id", "doc_id")
    return (
        only_docs.select(F.lit("document_without_label").alias("side"), "doc_id")
        .unionByName(only_labels.select(F.lit("label_without_document").alias("side"), "doc_id"))
    )


@query("reconciliation")
def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim names without a profile and profile names without a claim."""
    claims = fixtures.claims_raw(spark, sf_dir)
    profiles = raw_profiles(spark, sf_dir)
    return reconcile.reconciliation(claims, "Instituição financeira", profiles, "Nome", "claims", "profiles")


@query("reconciliation_counts")
def q_reconciliation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of unmatched names on each side."""
    return reconcile.reconciliation_summary(q_reconciliation(spark, sf_dir))


@query("reconciliation_spelling")
def q_reconciliation_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 with names left over on both sides: case and accents are bridged, other spellings are not."""
    claims, registry = fixtures.spelled_names(spark, sf_dir)
    return reconcile.reconciliation(claims, "name", registry, "name", "claims", "registry")


@query("name_proposals")
def q_name_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry names proposed for the claims' unmatched names, q-gram similarity of 45 % or more."""
    return similarity.name_proposals(q_reconciliation_spelling(spark, sf_dir), "claims", "registry", least=45, largest=10_000)


@query("override_names")
def q_override_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An override table, derived from the data, applied by exact value."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    overrides = (
        o.select("o_orderpriority").distinct()
        .where(F.col("o_orderpriority").endswith("URGENT"))
        .select(F.col("o_orderpriority").alias("from_name"),
                F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("to_name"))
    )
    return reconcile.apply_overrides(o, "o_orderpriority", overrides)


@query("distinct_rows")
def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows of the events, sent twice and with every third row a third time."""
    ev = read_table(spark, sf_dir, "events")
    return dedup.distinct_rows(ev.unionByName(ev).unionByName(ev.where(F.col("event_id") % 3 == 0)))


@query("dedup_subset")
def q_dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, type); only the key columns are deterministic."""
    ev = read_table(spark, sf_dir, "events")
    return dedup.dedup_subset(ev, ["user_id", "event_type"]).select("user_id", "event_type")


@query("dedup_row_number")
def q_dedup_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event per (user, type) by ROW_NUMBER in a FROM sub-query."""
    ev = read_table(spark, sf_dir, "events")
    return spark.sql(
        """
        SELECT event_id, ts, user_id, event_type, value, props
        FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS row_num
            FROM {events}
        ) ranked
        WHERE row_num = 1
        """,
        events=ev,
    )


@query("dedup_first_by")
def q_dedup_first_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 through the DataFrame operator: latest event per user."""
    ev = read_table(spark, sf_dir, "events")
    return dedup.first_by(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


@query("limit_preview")
def q_limit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/L2: the first 100 lines in key order (an ordered preview is the feature)."""
    li = read_table(spark, sf_dir, "lineitem")
    # (order, line) is not unique in the driver's lineitem: the other columns
    # complete the order so that the first 100 rows are well defined.
    return li.orderBy("l_orderkey", "l_linenumber", *(c for c in li.columns if c not in ("l_orderkey", "l_linenumber"))).limit(100)


@query("sql_limit")
def q_sql_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: SQL LIMIT over a unique order."""
    return spark.sql("SELECT * FROM {orders} ORDER BY o_orderkey LIMIT 50",
                     orders=read_table(spark, sf_dir, "orders"))


@query("union_missing_columns")
def q_union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers by name; suppliers have no segment."""
    c = rename_columns(read_table(spark, sf_dir, "customer"), {
        "c_custkey": "party_key", "c_name": "name", "c_nationkey": "nation_key",
        "c_acctbal": "balance", "c_mktsegment": "segment"})
    s = rename_columns(read_table(spark, sf_dir, "supplier"), {
        "s_suppkey": "party_key", "s_name": "name", "s_nationkey": "nation_key", "s_acctbal": "balance"})
    return union_by_name(c.withColumn("party", F.lit("customer")), s.withColumn("party", F.lit("supplier")))


@query("rename_project")
def q_rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename by map, view round trip, drop, derived columns."""
    raw = fixtures.institutions_raw(spark, sf_dir)
    renamed = rename_columns(raw, INSTITUTIONS.rename_map())
    view = _view_name("institutions_renamed")
    renamed.createOrReplaceTempView(view)
    df = spark.table(view).drop("financial_institution_name")
    return df.withColumns({
        "cnpj": text.pad_id("cnpj"),
        "segment_lower": F.lower("segment"),
    })


@query("column_difference")
def q_column_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the order columns the customer table lacks, plus the join key."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return keep_only(o, column_difference(o, c, keep=["o_custkey"]))


# --------------------------------------------------------------------------
# Quality and inspection
# --------------------------------------------------------------------------

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split()


@query("row_counts")
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1/R2: one audit row per table."""
    return quality.row_counts({t: read_table(spark, sf_dir, t) for t in DRIVER_TABLES})


@query("column_profile")
def q_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, non-null count and row count of every orders column."""
    return quality.column_profile(read_table(spark, sf_dir, "orders"))


@query("pk_violations")
def q_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, segment) keys repeated in the profiles before de-duplication."""
    prof = trusted_profiles(raw_profiles(spark, sf_dir), dedup=False)
    return quality.pk_violations(prof, list(PROFILES.primary_key))


@query("pk_violations_claims")
def q_pk_violations_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, year, quarter) keys that several claims share."""
    return quality.pk_violations(q_trusted_claims(spark, sf_dir), list(CLAIMS.primary_key))


@query("contract_violations")
def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of the registry (ids longer than eight digits are kept (D2) and reported here, names
    missing) and of the claims while they are still text (years and names missing, numbers that are none)."""
    registry = fixtures.institutions_raw(spark, sf_dir).withColumns({
        "CNPJ": (F.trim("CNPJ").cast("bigint") * 100003).cast("string"),
        "Nome": F.when(F.col("Segmento") != "AUTOMOBILE", F.col("Nome"))})
    claims = fixtures.claims_raw(spark, sf_dir).withColumns({
        "Ano": F.when(F.col("Tipo") != "P", F.col("Ano")),
        "Instituição financeira": F.nullif(F.col("Instituição financeira"), F.lit("SEM NOME"))})
    claims = rename_columns(claims, CLAIMS.rename_map())
    return (quality.contract_violations(trusted_institutions(registry), INSTITUTIONS, "institutions")
            .unionByName(quality.contract_violations(claims, CLAIMS, "claims")))


@query("cast_failures")
def q_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claim text that was present but did not survive its cast."""
    return quality.cast_failures(fixtures.claims_raw(spark, sf_dir), CLAIMS)


@query("sql_cleaners")
def q_sql_cleaners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaners as SQL functions over views."""
    register_sql_functions(spark)
    raw_view, clean_view = _view_name("institutions_raw"), _view_name("institutions_clean")
    register_views({raw_view: fixtures.institutions_raw(spark, sf_dir)})
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW {clean_view} AS
        SELECT Segmento AS segment, md_pad_id(CNPJ) AS cnpj,
               md_strip_prudential(Nome) AS financial_institution_name
        FROM {raw_view}
    """)
    return spark.sql(f"""
        SELECT cnpj, segment, financial_institution_name,
               md_name_key(financial_institution_name) AS sk_financial_institution_name,
               md_name_norm(md_unaccent(financial_institution_name)) AS name_norm,
               sha1(concat(cnpj, segment)) AS sk_cnpj_segment
        FROM {clean_view}
    """)


# --------------------------------------------------------------------------
# Sources and sinks: write -> read round trips in a fresh shared folder
# --------------------------------------------------------------------------


@query("csv_tab_roundtrip")
def q_csv_tab_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry written tab-separated (UTF-8) and read back by contract."""
    path = write_delimited(fixtures.institutions_raw(spark, sf_dir), scratch_path(spark, "institutions_tsv"),
                           sep="\t", encoding="UTF-8")
    raw = delimited.read_contract(spark, path, INSTITUTIONS)
    return trusted_institutions(raw.drop("source_file"))


@query("csv_pipe_roundtrip")
def q_csv_pipe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pipe files with different column sets, read as one table."""
    main, second = fixtures.profiles_raw(spark, sf_dir)
    root = scratch_path(spark, "profiles_psv")
    write_delimited(main, f"{root}/main", sep="|")
    write_delimited(second, f"{root}/second", sep="|")
    raw = delimited.read_contract(spark, [f"{root}/main", f"{root}/second"], PROFILES)
    return trusted_profiles(raw).drop("source_file")


@query("csv_semicolon_latin1")
def q_csv_semicolon_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/TR4/TR5: cp1252-style claims file (C1 dash in headers, trailing ';') read as Latin-1."""
    path = write_delimited(fixtures.claims_raw(spark, sf_dir), scratch_path(spark, "claims_csv"),
                           sep=";", encoding="ISO-8859-1", trailing_separator=True, cp1252_headers=True)
    raw = delimited.read_contract(spark, path, CLAIMS)
    return trusted_claims(raw.drop("source_file"))


@query("folder_union_by_header")
def q_folder_union_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4/U1/TR3: two folders whose files order the same columns differently."""
    c = read_table(spark, sf_dir, "customer")
    text_cols = [F.col(x).cast("string").alias(x) for x in c.columns]
    root = scratch_path(spark, "customer_folders")
    write_delimited(c.where(F.col("c_acctbal") >= 0).select(*text_cols), f"{root}/a", sep="|")
    write_delimited(c.where(F.col("c_acctbal") < 0).select(*reversed(text_cols)), f"{root}/b", sep="|")
    df = delimited.read_folder(spark, [f"{root}/a", f"{root}/b"], sep="|", malformed_column=None)
    return casts.cast_map(df.drop("source_file"), {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


@query("encoding_audit")
def q_encoding_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoding of every folder of name files and how sure it is, decided on the executors."""
    c = read_table(spark, sf_dir, "customer")
    root = scratch_path(spark, "encodings")
    accented = F.translate("c_name", "uo", "úõ")
    dash = F.concat(F.col("c_name"), F.lit(" \u0096 "), F.col("c_mktsegment"))  # cp1252 en dash at its C1 point
    variants = {
        "ascii": (F.col("c_name"), "UTF-8"),
        "utf8": (accented, "UTF-8"),
        "latin1": (accented, "ISO-8859-1"),
        "cp1252": (dash, "ISO-8859-1"),
        "cp850": (F.translate("c_name", "uo", "\u00a3\u00e4"), "ISO-8859-1"),  # u and o with accents, at their cp850 bytes
    }
    for folder, (value, enc) in variants.items():
        (c.select(value.alias("name")).write.mode("errorifexists")
         .option("header", False).option("encoding", enc).csv(f"{root}/{folder}"))
    audit = charset.encoding_audit(spark, f"{root}/*", by="folder")
    return audit


@query("folder_auto_encoding")
def q_folder_auto_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 feeding S4: files in UTF-8, cp1252, UTF-16 with and without mark, and UTF-8 with a NUL, read as one table."""
    c = read_table(spark, sf_dir, "customer")
    root = scratch_path(spark, "auto_encoding")
    key, name = F.col("c_custkey").cast("string").alias("c_custkey"), F.translate("c_name", "uo", "úõ").alias("name")
    dash, nul = F.lit(" \u0096 x"), F.lit("\x00")
    kinds = [("utf8", "UTF-8", F.col("c_mktsegment")), ("cp1252", "ISO-8859-1", F.concat("c_mktsegment", dash)),
             ("utf16", "UTF-16", F.col("c_mktsegment")), ("nul", "UTF-8", F.concat("c_mktsegment", nul)),
             ("utf16le", "UTF-16LE", F.col("c_mktsegment"))]
    for k, (folder, charset_name, segment) in enumerate(kinds):
        rows = c.where(F.col("c_nationkey") % 5 == k).select(key, name, F.lit(folder).alias("origin"), segment.alias("segment"))
        write_delimited(rows, f"{root}/{folder}", sep=";", encoding=charset_name)
    df = delimited.read_folder(spark, root, sep=";", encoding="auto")
    return df.select(casts.to_long("c_custkey").alias("c_custkey"), "name", "origin", F.replace("segment", nul, F.lit("")).alias("segment"))


@query("csv_malformed")
def q_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with missing and surplus fields keep their line."""
    c = read_table(spark, sf_dir, "customer")
    header = "c_custkey;name;segment"
    fields = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")]
    kind = F.col("c_nationkey") % 3
    line = (F.when(F.col("c_nationkey") % 4 == 0, F.concat_ws(";", *fields, F.lit("surplus")))
            .when(kind == 1, fields[0]).when(kind == 2, F.concat_ws(";", *fields[:2])).otherwise(F.concat_ws(";", *fields)))
    root = scratch_path(spark, "malformed")
    # one column under a separator that does not occur: the lines are written as they are
    c.select(line.alias(header)).write.option("header", True).option("sep", "\x01").option("quote", "").csv(root)
    df = delimited.read_folder(spark, root, sep=";")
    return df.select(casts.to_long("c_custkey").alias("c_custkey"), "name", "segment", F.col(delimited.MALFORMED).alias("line"))


@query("csv_multiline")
def q_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted values with line breaks, blank lines, separators and quotes, in files of two headers, read in splits."""
    o = read_table(spark, sf_dir, "orders")
    note = (F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit('\nsaid "yes; no"\n\n;'), "o_orderstatus"))
            .when(F.col("o_orderstatus") == "O", F.concat(F.lit('5" disk '), "o_orderpriority")).otherwise(F.concat(F.lit('"\n"\n'), "o_orderpriority")))
    rows = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), note.alias("the\nnote"), F.col("o_custkey").cast("string").alias("o_custkey"))
    root = scratch_path(spark, "multiline")
    write_delimited(rows.where(F.col("o_orderpriority") < "3"), f"{root}/a", sep=";")
    write_delimited(rows.where(F.col("o_orderpriority") >= "3").select(*reversed(rows.columns)), f"{root}/b", sep=";")
    # a split size far below a file's, so that values go over the ends of splits at every scale
    df = delimited.read_folder(spark, root, sep=";", multiline=True, split_bytes=1 << 15)
    return df.select(casts.to_long("o_orderkey").alias("o_orderkey"), F.col("the\nnote").alias("note"), casts.to_long("o_custkey").alias("o_custkey"),
                     F.col(delimited.MALFORMED).alias("line"))


@query("csv_pick_and_infer")
def q_csv_pick_and_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a folder that match a name, with inferred types; rows too short and too long are told by their kept lines."""
    c = read_table(spark, sf_dir, "customer")
    root = scratch_path(spark, "picked")
    write_delimited(c.select("c_custkey", "c_name", "c_acctbal"), root, sep="|")
    c.select(F.lit("not this one").alias("value")).write.mode("append").text(root)
    some = c.where(F.col("c_custkey") % 10 == 3)
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("c_custkey", "c_name", "c_acctbal")]
    untidy = some.select(F.concat_ws("|", *fields, F.lit("surplus"))).union(some.select(F.concat_ws("|", *fields[:2])))
    write_delimited(untidy.toDF("c_custkey|c_name|c_acctbal"), root, sep="\x01", mode="append")
    df = delimited.read_delimited(spark, root, sep="|", glob="*.csv", infer_schema=True, malformed_column=delimited.MALFORMED)
    return df.withColumnRenamed(delimited.MALFORMED, "line")


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snappy parquet, fail-if-exists mode, read back."""
    path = write_parquet(read_table(spark, sf_dir, "orders"), scratch_path(spark, "orders_pq"), mode="errorifexists")
    return spark.read.parquet(path)


@query("parquet_append")
def q_parquet_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: two appends of the same batch give it twice."""
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_append")
    write_parquet(o, path, mode="append")
    write_parquet(o, path, mode="append")
    return spark.read.parquet(path)


@query("parquet_overwrite")
def q_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: overwrite replaces what an earlier run wrote (re-runs are idempotent)."""
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_overwrite")
    write_parquet(o.withColumn("o_orderstatus", F.lit("old")).unionByName(o), path, mode="overwrite")
    write_parquet(o, path, mode="overwrite")
    write_parquet(o, path, mode="overwrite")
    return spark.read.parquet(path)


@query("parquet_overwrite_period")
def q_parquet_overwrite_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 for one period: the last quarter of the orders is replaced by a new version, all others stay."""
    o = read_table(spark, sf_dir, "orders").withColumns({"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate")})
    path = write_parquet(o, scratch_path(spark, "orders_by_quarter"), partition_by=["year", "quarter"])
    last = tuple(o.agg(F.max(F.struct("year", "quarter")).alias("x")).select("x.*").first())
    version = o.where((F.col("year") == last[0]) & (F.col("quarter") == last[1])).withColumns({
        "o_totalprice": -F.col("o_totalprice"), "o_orderstatus": F.lit("R")})
    replace_periods(version, path, ["year", "quarter"], [last])
    return spark.read.schema(o.schema).parquet(path)


@query("batch_append")
def q_batch_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/K6/K8: the orders in one batch a status, each staged and committed once; a repeated batch adds nothing."""
    o = read_table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    table = scratch_path(spark, "orders_batches")
    for status in ("F", "O", "P", "F", "O"):
        write_batch(o.where(F.col("o_orderstatus") == status), table, f"status-{status}", ["year"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in o.schema.fields)
    return read_batches(spark, table, schema).join(batch_counts(spark, table), "batch")


@query("sql_copy_parquet")
def q_sql_copy_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COPY-style SQL export, then SQL scan of the folder through a view."""
    src_view, copy_view = _view_name("lineitem_src"), _view_name("lineitem_copy")
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView(src_view)
    path = scratch_path(spark, "lineitem_copy")
    sql_copy_parquet(spark, src_view, path)
    register_scan(spark, copy_view, path)
    return sql_scan(spark, path).unionByName(spark.table(copy_view))


# --------------------------------------------------------------------------
# Layer jobs end to end, and incremental ingestion
# --------------------------------------------------------------------------


@query("delivery_from_layers")
def q_delivery_from_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, trusted and delivery layers written as parquet; delivery read back."""
    main, second = fixtures.profiles_raw(spark, sf_dir)
    raw = build_raw(
        main.withColumn("source_file", F.lit("profiles_main")),
        second.withColumn("source_file", F.lit("profiles_second")),
        fixtures.institutions_raw(spark, sf_dir),
        fixtures.claims_raw(spark, sf_dir),
    )
    return run_pipeline(spark, raw, scratch_path(spark, "layers"))


@query("delivery_incremental")
def q_delivery_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery table made from two batches of claims, one after the other, and one that is sent again."""
    claims, root = fixtures.claims_raw(spark, sf_dir), scratch_path(spark, "delivery_incremental")
    registry, profiles = q_trusted_institutions(spark, sf_dir), q_trusted_profiles(spark, sf_dir)
    for name, batch in (("first", F.col("Tipo") != "P"), ("second", F.col("Tipo") == "P"), ("first", F.col("Tipo") != "P")):
        incremental.add_claims(spark, root, name, claims.where(batch))
        incremental.refresh_delivery(spark, root, registry, profiles)
    return incremental.read_delivery(spark, root)


@query("claims_incremental_ingest")
def q_claims_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 via Structured Streaming: two deliveries of claim files, each run appends only new files."""
    claims = fixtures.claims_raw(spark, sf_dir)
    root = scratch_path(spark, "claims_landing")
    landing, target, ckpt = f"{root}/landing", f"{root}/raw_claims", f"{root}/_checkpoint"
    batches = [claims.where(F.col("Tipo") == "F"), claims.where(F.col("Tipo") != "F")]
    for i, batch in enumerate(batches):
        # the second delivery has its columns in another order
        ordered = batch if i == 0 else batch.select(*[F.col(f"`{c}`") for c in reversed(batch.columns)])
        write_delimited(ordered, f"{landing}/delivery={i}", sep=";", encoding="ISO-8859-1",
                        trailing_separator=True, cp1252_headers=True)
        run_once(spark, landing, CLAIMS, target, ckpt)
    return trusted_claims(spark.read.parquet(target))


@query("alias_map_join")
def q_alias_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T17 at scale: the alias table as a DataFrame joined in (planner decides broadcast)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    mapping = spark.createDataFrame(list(SEGMENT_ALIASES.items()), "from_value string, to_value string")
    return text.map_by_join(c, "segment", mapping)


@query("catalog_table")
def q_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery published as a catalog table created with the contract's types."""
    table = f"dlzd_{DELIVERY.name}_{uuid.uuid4().hex[:8]}"
    out = publish_table(spark, q_delivery_satisfaction(spark, sf_dir), table, scratch_path(spark, table), DELIVERY)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay, nothing is left in the catalog
    return out


@query("layer_audit")
def q_layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: row counts of every layer table, observed on the writes themselves."""
    main, second = fixtures.profiles_raw(spark, sf_dir)
    raw = build_raw(
        main.withColumn("source_file", F.lit("profiles_main")),
        second.withColumn("source_file", F.lit("profiles_second")),
        fixtures.institutions_raw(spark, sf_dir),
        fixtures.claims_raw(spark, sf_dir),
    )
    audit: dict[str, int] = {}
    run_pipeline(spark, raw, scratch_path(spark, "layers_audit"), audit=audit)
    rows = [(name.split(".")[0], name.split(".")[1], n) for name, n in sorted(audit.items())]
    return spark.createDataFrame(rows, "layer string, table_name string, total bigint")


@query("delivery_contract_violations")
def q_delivery_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 on the published table: every length rule of the delivery contract, one pass."""
    return quality.contract_violations(q_delivery_satisfaction(spark, sf_dir), DELIVERY, "delivery")
