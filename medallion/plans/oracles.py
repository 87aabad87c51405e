"""Independent SQL for every registered query (DuckDB dialect, base tables).

Each oracle goes straight to the driver's tables and states the expected
result from the dirt recipe of ``plans.fixtures`` -- it does not repeat the
library's cleaning logic.  Shared pieces are small SQL fragments.
"""

from __future__ import annotations

from medallion.contracts import PROFILE_SCORES


def pad8(expr: str) -> str:
    return f"CASE WHEN length({expr}) < 8 THEN lpad({expr}, 8, '0') ELSE {expr} END"


CUST_ID = pad8("CAST(c_custkey AS VARCHAR)")

# Where the claim dirt goes (see plans.fixtures.claims_raw).
NO_ID = "o_orderpriority = '5-LOW'"
NO_NAME = "o_orderpriority = '4-NOT SPECIFIED'"
CCS_BLANK = "o_orderpriority = '3-MEDIUM'"
ORDER_CUST_ID = pad8("CAST(o_custkey AS VARCHAR)")

# Trusted claims as they must come out of the cleaning, from orders + customer.
CLAIMS_SELECT = f"""
  CAST(year(o_orderdate) AS VARCHAR) AS year_claim,
  CAST(quarter(o_orderdate) AS INTEGER) AS quarter_claim,
  o_orderpriority || '; "' || o_orderstatus || '"' AS category,
  o_orderstatus AS bank_type,
  CASE WHEN {NO_ID} THEN NULL ELSE {ORDER_CUST_ID} END AS cnpj,
  CASE WHEN {NO_NAME} THEN 'SEM NOME'
       WHEN o_orderstatus = 'F' THEN upper(c_name)
       ELSE ' ' || c_name END AS financial_institution_name,
  CASE WHEN month(o_orderdate) IN (6, 12) THEN NULL ELSE o_totalprice END AS bank_index,
  CAST(c_nationkey AS BIGINT) AS number_of_regulated_proceeding_complaints,
  CAST(day(o_orderdate) AS BIGINT) AS number_of_regulated_other_complaints,
  CAST(month(o_orderdate) AS BIGINT) AS number_of_unregulated_complaints,
  CAST(c_nationkey + day(o_orderdate) + month(o_orderdate) AS BIGINT) AS total_number_of_complaints,
  CASE WHEN {CCS_BLANK} THEN NULL ELSE CAST(o_custkey * 3 AS BIGINT) END AS total_number_of_ccs_and_scr_customers,
  CASE WHEN {CCS_BLANK} THEN NULL ELSE CAST(o_custkey * 2 AS BIGINT) END AS number_of_ccs_customers,
  CASE WHEN {CCS_BLANK} THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS number_of_scr_customers,
  sha1(CASE WHEN {NO_NAME} THEN 'semnome' ELSE lower(c_name) END) AS sk_financial_institution_name"""

CLAIM_NAMES = [
    "year_claim", "quarter_claim", "category", "bank_type", "cnpj", "financial_institution_name",
    "bank_index", "number_of_regulated_proceeding_complaints", "number_of_regulated_other_complaints",
    "number_of_unregulated_complaints", "total_number_of_complaints", "total_number_of_ccs_and_scr_customers",
    "number_of_ccs_customers", "number_of_scr_customers", "sk_financial_institution_name",
]


def _scores_sql() -> str:
    out = []
    for k, (raw, clean) in enumerate(PROFILE_SCORES):
        if raw.endswith("(%)"):
            out.append(f"CAST(40 + (c_custkey + {k}) % 60 AS DOUBLE) AS {clean}")
        else:
            out.append(
                f"CAST(CAST(1 + (c_nationkey + {k}) % 5 AS VARCHAR) || '.' || "
                f"CAST((c_custkey + {k}) % 10 AS VARCHAR) AS DOUBLE) AS {clean}")
    return ",\n  ".join(out)


# Profile columns of a customer's (surviving, up-to-date) profile.
PROFILE_SELECT = f"""
  c_name AS employer_name,
  CAST(c_nationkey * 37 + 11 AS BIGINT) AS reviews_count,
  CAST(c_nationkey * 13 + 3 AS BIGINT) AS culture_count,
  CAST(c_nationkey * 51 + 7 AS BIGINT) AS salaries_count,
  CAST(c_nationkey * 9 + 1 AS BIGINT) AS benefits_count,
  'http://www.' || lower(c_mktsegment) || '.example.com' AS employer_website,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Paris, França' ELSE 'São Paulo, Brasil' END AS employer_headquarters,
  CAST(CASE WHEN c_nationkey <> 0 THEN 1900 + c_nationkey * 4 END AS INTEGER) AS employer_founded,
  c_mktsegment AS employer_industry,
  'Desconhecida/não se aplica | "R$ 1; 2"' || chr(9) AS employer_revenue,
  'https://example.com/employers/' || CAST(c_custkey AS VARCHAR) AS url,
  {_scores_sql()}"""

PROFILE_TAIL = """
  translate(c_name, 'uo', 'úõ') AS financial_institution_name,
  CASE WHEN c_nationkey % 2 = 0 THEN 'Paris' ELSE 'São Paulo' END AS headquarters_city,
  CASE WHEN c_nationkey % 2 = 0 THEN 'França' ELSE 'Brasil' END AS headquarters_country,
  sha1(lower(c_name)) AS sk_financial_institution_name"""


ORACLES: dict[str, str] = {}

ORACLES["trusted_institutions"] = f"""
SELECT c_mktsegment AS segment, {CUST_ID} AS cnpj, c_name AS financial_institution_name,
       sha1({CUST_ID} || c_mktsegment) AS sk_cnpj_segment
FROM customer
"""

ORACLES["trusted_claims"] = f"""
SELECT {CLAIMS_SELECT}
FROM orders JOIN customer ON o_custkey = c_custkey
"""

ORACLES["trusted_profiles"] = f"""
SELECT {PROFILE_SELECT},
  CASE WHEN c_acctbal < 0 THEN 'NONE' ELSE c_mktsegment END AS segment,
  CAST(NULL AS VARCHAR) AS cnpj,
  100 AS match_percent,
  'profiles_main' AS source_file,
  {PROFILE_TAIL}
FROM customer
UNION ALL
SELECT {PROFILE_SELECT},
  CAST(NULL AS VARCHAR) AS segment,
  {CUST_ID} AS cnpj,
  70 AS match_percent,
  'profiles_second' AS source_file,
  {PROFILE_TAIL}
FROM customer WHERE c_acctbal < 0
"""

ORACLES["delivery_satisfaction"] = f"""
WITH cl AS (
  SELECT o_custkey, c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, {CLAIMS_SELECT}
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE NOT ({NO_ID})
),
named AS (
  SELECT DISTINCT o_custkey FROM orders WHERE NOT ({NO_ID}) AND NOT ({NO_NAME})
)
SELECT DISTINCT {", ".join("cl." + c for c in CLAIM_NAMES)},
  c_mktsegment AS segment,
  sha1(cl.cnpj || c_mktsegment) AS sk_cnpj_segment,
  {PROFILE_SELECT},
  100 AS match_percent
FROM cl JOIN named USING (o_custkey)
WHERE c_acctbal >= 0
"""

PRICE_TEXT_NULL = "month(o_orderdate) IN (6, 12)"

ORACLES["pad_id"] = f"""
SELECT c_custkey, {CUST_ID} AS id_padded, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS id_lpad,
       {pad8("CAST(c_custkey * 100003 AS VARCHAR)")} AS long_padded,
       lpad(CAST(c_custkey * 100003 AS VARCHAR), 8, '0') AS long_lpad
FROM customer
"""

ORACLES["locale_decimal"] = f"""
SELECT o_orderkey, CASE WHEN {PRICE_TEXT_NULL} THEN NULL ELSE o_totalprice END AS price FROM orders
"""

ORACLES["quarter_ordinal"] = """
SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS quarter_claim FROM orders
"""

ORACLES["founded_year"] = """
SELECT c_custkey,
       CAST(CASE WHEN c_nationkey <> 0 THEN 1900 + c_nationkey * 4 END AS INTEGER) AS founded_cut,
       CAST(CASE WHEN c_nationkey <> 0 THEN 1900 + c_nationkey * 4 END AS BIGINT) AS founded_via_double
FROM customer
"""

ORACLES["cast_map"] = "SELECT * FROM lineitem"

ORACLES["unaccent_documents"] = """
SELECT doc_id, sha1(replace(strip_accents(text), 'ß', 'ss')) AS text_sha1,
       CAST(length(replace(strip_accents(text), 'ß', 'ss')) AS INTEGER) AS n_chars_folded
FROM documents
"""
ORACLES["unaccent_udf"] = ORACLES["unaccent_documents"]

ORACLES["strip_markers"] = """
SELECT c_custkey, c_name AS claim_name, c_name AS registry_name, c_name AS registry_name_paren FROM customer
"""

ORACLES["split_parts"] = """
SELECT page_id, trim(split_part(url, '/', 3)) AS host, trim(split_part(url, '/', 4)) AS lang,
       trim(split_part(url, '/', 1)) AS scheme
FROM pages
"""

ORACLES["text_normalise"] = """
SELECT c_custkey,
  lower('  ' || c_name || ' ' || chr(9) || c_mktsegment || ' ') AS lowered,
  c_name || ' ' || chr(9) || c_mktsegment AS stripped,
  c_name || chr(9) || c_mktsegment AS no_spaces,
  c_name || c_mktsegment AS no_whitespace,
  regexp_replace(c_name, '#0+', '#', 'g') AS short_name,
  replace(c_name, 'Customer', 'Cliente') AS renamed,
  c_mktsegment || '/' || c_name AS joined
FROM customer
"""

ORACLES["alias_map"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'BUILDING' THEN 'CONSTRUCTION'
                  WHEN 'BB' THEN 'BANCO DO BRASIL' ELSE c_mktsegment END AS segment
FROM customer
"""

ORACLES["alias_substring"] = """
SELECT p_partkey, replace(replace(replace(p_type, 'BRASS', 'LATÃO'), 'STEEL', 'AÇO'), 'PROMO', 'PROMOÇÃO') AS p_type_pt
FROM part
"""

ORACLES["blank_to_null"] = """
SELECT o_orderkey,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(o_custkey * 2 AS VARCHAR) END AS ccs_text,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(o_custkey * 2 AS BIGINT) END AS ccs_customers
FROM orders
"""

ORACLES["conditional_value"] = """
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid'
                   ELSE 'low' END AS price_band
FROM orders
"""

ORACLES["sha1_key"] = "SELECT c_custkey, sha1(c_name) AS name_sha1 FROM customer"
ORACLES["md5_key"] = "SELECT c_custkey, md5(c_name) AS name_md5 FROM customer"

# one key for all spellings; the dashed name's key has the ASCII dash
ORACLES["name_key"] = "SELECT c_custkey, " + ", ".join(
    f"sha1(lower(c_name)) AS {k}_key" for k in ("registry", "profile", "claim", "no_break", "decomposed", "extended")
) + ", sha1(lower(replace(c_name, '#', '-'))) AS dashed_key, sha1(lower(replace(c_name, '#', '-'))) AS en_dashed_key FROM customer"

ORACLES["document_key"] = f"""
SELECT c_custkey, sha1({CUST_ID} || c_mktsegment) AS sk_sha1, md5({CUST_ID} || c_mktsegment) AS sk_md5
FROM customer
"""

CLAIMS_FROM = "FROM orders JOIN customer ON o_custkey = c_custkey"

ORACLES["join_id"] = f"""
SELECT {CLAIMS_SELECT}, c_mktsegment AS segment, sha1({ORDER_CUST_ID} || c_mktsegment) AS sk_cnpj_segment
{CLAIMS_FROM} WHERE NOT ({NO_ID})
"""

# Profiles that survive de-duplication, keyed by customer (main file + second file).
SURVIVING_PROFILES = f"""
  SELECT c_custkey AS pkey, c_name AS employer_name,
         CASE WHEN c_acctbal < 0 THEN 'NONE' ELSE c_mktsegment END AS segment,
         100 AS match_percent, 'profiles_main' AS source_file, {PROFILE_SELECT},
         CASE WHEN c_nationkey % 2 = 0 THEN 'Paris' ELSE 'São Paulo' END AS headquarters_city,
         CASE WHEN c_nationkey % 2 = 0 THEN 'França' ELSE 'Brasil' END AS headquarters_country
  FROM customer
  UNION ALL
  SELECT c_custkey, c_name, NULL, 70, 'profiles_second', {PROFILE_SELECT},
         CASE WHEN c_nationkey % 2 = 0 THEN 'Paris' ELSE 'São Paulo' END,
         CASE WHEN c_nationkey % 2 = 0 THEN 'França' ELSE 'Brasil' END
  FROM customer WHERE c_acctbal < 0
"""

ORACLES["join_name_key"] = f"""
WITH cl AS (SELECT o_custkey, {CLAIMS_SELECT} {CLAIMS_FROM} WHERE NOT ({NO_NAME})),
pr AS ({SURVIVING_PROFILES})
SELECT {", ".join("cl." + c for c in CLAIM_NAMES)}, pr.employer_name, pr.segment, pr.match_percent, pr.source_file
FROM cl JOIN pr ON cl.o_custkey = pr.pkey
"""

ORACLES["delivery_satisfaction_late"] = ORACLES["delivery_satisfaction"]

ORACLES["delivery_satisfaction_sql"] = f"""
WITH cl AS (SELECT o_custkey, c_mktsegment AS bank_segment, {CLAIMS_SELECT} {CLAIMS_FROM}
            WHERE NOT ({NO_ID}) AND NOT ({NO_NAME})),
pr AS ({SURVIVING_PROFILES})
SELECT cl.year_claim, cl.quarter_claim, cl.category, cl.bank_type, cl.cnpj, cl.financial_institution_name,
       cl.bank_index, cl.sk_financial_institution_name, cl.bank_segment AS segment,
       pr.employer_website, pr.headquarters_city, pr.headquarters_country, pr.employer_founded,
       pr.employer_industry, pr.employer_revenue, pr.general_score, pr.culture_values_score,
       pr.diversity_inclusion_score, pr.life_quality_score, pr.senior_leadership_score,
       pr.compensation_benefits_score, pr.career_opportunities_score, pr.recommendation_score,
       pr.company_positive_score, pr.reviews_count, pr.culture_count, pr.salaries_count,
       pr.benefits_count, pr.match_percent
FROM cl JOIN pr ON cl.o_custkey = pr.pkey
"""

ORACLES["anti_both_ways"] = """
SELECT 'document_without_label' AS side, doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT 'label_without_document', doc_id FROM labels l
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
"""

ORACLES["reconciliation"] = f"""
SELECT 'claims' AS side, 'SEM NOME' AS name, 'semnome' AS name_norm
WHERE EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE {NO_NAME})
UNION ALL
SELECT 'profiles', translate(c_name, 'uo', 'úõ'), lower(c_name) FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND NOT ({NO_NAME}))
"""

ORACLES["override_names"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT' THEN split_part(o_orderpriority, '-', 2)
                   ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

ORACLES["distinct_rows"] = "SELECT DISTINCT * FROM events"
ORACLES["dedup_subset"] = "SELECT DISTINCT user_id, event_type FROM events"

ORACLES["dedup_row_number"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
"""

ORACLES["dedup_first_by"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLES["limit_preview"] = """
SELECT * FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate LIMIT 100
"""

ORACLES["union_missing_columns"] = """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key, c_acctbal AS balance,
       c_mktsegment AS segment, 'customer' AS party FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier
"""

ORACLES["rename_project"] = f"""
SELECT c_mktsegment AS segment, {CUST_ID} AS cnpj, lower(c_mktsegment) AS segment_lower FROM customer
"""

ORACLES["column_difference"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_custkey FROM orders
"""

ORACLES["row_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS total FROM {t}"
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()
)

_ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
ORACLES["column_profile"] = "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null, "
    f"COUNT(*) AS total FROM orders"
    for i, (c, t) in enumerate(_ORDERS_TYPES)
)

ORACLES["pk_violations_claims"] = f"""
SELECT financial_institution_name, year_claim, quarter_claim, COUNT(*) AS occurrences
FROM (SELECT {CLAIMS_SELECT} {CLAIMS_FROM}) GROUP BY ALL HAVING COUNT(*) > 1
"""

ORACLES["pk_violations"] = """
SELECT translate(c_name, 'uo', 'úõ') AS financial_institution_name,
       CASE WHEN c_acctbal < 0 THEN 'NONE' ELSE c_mktsegment END AS segment,
       CAST(2 AS BIGINT) AS occurrences
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
"""



def _violations_sql(contract, table: str, source: str, text_rules: bool = False, broken: dict | None = None) -> str:
    """One row for each rule of the contract over ``source``; ``broken`` has the condition of rules that some rows break."""
    parts = []
    for f in contract.fields:
        rules = ["not_null"] * (not f.nullable) + ["max_length"] * (f.max_length is not None and f.dtype == "string")
        rules += ["numeric"] * (f.dtype != "string" and (text_rules or f.decimal is not None))
        if text_rules and f.raw is None:
            continue
        for rule in rules:
            plain = {"not_null": f"{f.name} IS NULL", "max_length": f"length({f.name}) > {f.max_length}"}.get(rule, "FALSE")
            if f.decimal and not text_rules and rule == "numeric":
                plain = f"abs(round({f.name}, {f.decimal[1]})) >= {10 ** (f.decimal[0] - f.decimal[1])}"
            condition = (broken or {}).get((f.name, rule), "FALSE" if broken is not None else plain)
            parts.append(f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, '{rule}' AS rule, "
                         f"CAST(COALESCE(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _contract_violations_sql() -> str:
    from medallion.contracts import CLAIMS, INSTITUTIONS

    registry = _violations_sql(INSTITUTIONS, "institutions", "customer", broken={
        ("segment", "max_length"): "length(c_mktsegment) > 10",
        ("cnpj", "max_length"): "length(CAST(c_custkey * 100003 AS VARCHAR)) > 8",
        ("financial_institution_name", "not_null"): "c_mktsegment = 'AUTOMOBILE'"})
    claims = _violations_sql(CLAIMS, "claims", f"(SELECT * {CLAIMS_FROM})", text_rules=True, broken={
        ("year_claim", "not_null"): "o_orderstatus = 'P'",
        ("financial_institution_name", "not_null"): NO_NAME,
        ("bank_index", "numeric"): "month(o_orderdate) = 6"})
    return registry + "\nUNION ALL\n" + claims


ORACLES["contract_violations"] = _contract_violations_sql()

_CLAIM_TYPED = [("quarter_claim", "int"), ("bank_index", "double"),
                ("number_of_regulated_proceeding_complaints", "bigint"),
                ("number_of_regulated_other_complaints", "bigint"),
                ("number_of_unregulated_complaints", "bigint"), ("total_number_of_complaints", "bigint"),
                ("total_number_of_ccs_and_scr_customers", "bigint"), ("number_of_ccs_customers", "bigint"),
                ("number_of_scr_customers", "bigint")]
ORACLES["cast_failures"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS target_type, "
    + ("CAST(SUM(CASE WHEN month(o_orderdate) = 6 THEN 1 ELSE 0 END) AS BIGINT)"
       if c == "bank_index" else "CAST(SUM(0) AS BIGINT)")
    + f" AS failures {CLAIMS_FROM}"
    for c, t in _CLAIM_TYPED
)

ORACLES["sql_cleaners"] = f"""
SELECT {CUST_ID} AS cnpj, c_mktsegment AS segment, c_name AS financial_institution_name,
       sha1(lower(c_name)) AS sk_financial_institution_name, lower(c_name) AS name_norm,
       sha1({CUST_ID} || c_mktsegment) AS sk_cnpj_segment
FROM customer
"""

ORACLES["csv_tab_roundtrip"] = ORACLES["trusted_institutions"]
ORACLES["csv_semicolon_latin1"] = ORACLES["trusted_claims"]
ORACLES["csv_pipe_roundtrip"] = f"""
SELECT * EXCLUDE (source_file) FROM ({ORACLES["trusted_profiles"]})
"""

ORACLES["folder_union_by_header"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""

# Three charsets read the Latin-1 names alike; names in cp850 make no sense in the charset they pass for.
ORACLES["encoding_audit"] = """
SELECT 'ascii' AS folder, 'ascii' AS encoding, CAST(1 AS DOUBLE) AS confidence, 'UTF-8' AS spark_charset, COUNT(*) AS lines FROM customer
UNION ALL SELECT 'utf8', 'utf-8', 1, 'UTF-8', COUNT(*) FROM customer
UNION ALL SELECT 'latin1', 'iso-8859-1', round(1 / 3, 4), 'ISO-8859-1', COUNT(*) FROM customer
UNION ALL SELECT 'cp1252', 'windows-1252', 1, 'ISO-8859-1', COUNT(*) FROM customer
UNION ALL SELECT 'cp850', 'iso-8859-1', 0, 'ISO-8859-1', COUNT(*) FROM customer
"""

ORACLES["parquet_roundtrip"] = "SELECT * FROM orders"
ORACLES["parquet_append"] = "SELECT * FROM orders UNION ALL SELECT * FROM orders"
ORACLES["parquet_overwrite"] = "SELECT * FROM orders"
ORACLES["sql_copy_parquet"] = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem"

ORACLES["delivery_from_layers"] = ORACLES["delivery_satisfaction"]
ORACLES["claims_incremental_ingest"] = ORACLES["trusted_claims"]

ORACLES["alias_map_join"] = ORACLES["alias_map"]
ORACLES["catalog_table"] = ORACLES["delivery_satisfaction"]

ORACLES["layer_audit"] = f"""
SELECT 'raw' AS layer, 'institutions' AS table_name, COUNT(*) AS total FROM customer
UNION ALL SELECT 'raw', 'profiles',
  (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
  + (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'raw', 'claims', COUNT(*) {CLAIMS_FROM}
UNION ALL SELECT 'trusted', 'institutions', COUNT(*) FROM customer
UNION ALL SELECT 'trusted', 'profiles',
  (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT 'trusted', 'claims', COUNT(*) {CLAIMS_FROM}
UNION ALL SELECT 'delivery', 'bank_employment_satisfaction', COUNT(*) FROM ({ORACLES["delivery_satisfaction"]})
"""

ORACLES["regex_replace_first"] = """
SELECT c_custkey,
  regexp_replace(c_name || '.' || c_mktsegment || '.' || CAST(c_nationkey AS VARCHAR), '\\.', '') AS first_dot_removed,
  regexp_replace(c_name || '.' || c_mktsegment || '.' || CAST(c_nationkey AS VARCHAR), '\\.', '', 'g') AS all_dots_removed,
  regexp_replace(c_name || '.' || c_mktsegment || '.' || CAST(c_nationkey AS VARCHAR), '#0+', '#') AS short_name
FROM customer
"""


def _delivery_violations_sql() -> str:
    from medallion.contracts import DELIVERY

    return f"WITH delivery AS ({ORACLES['delivery_satisfaction']})\n" + _violations_sql(DELIVERY, "delivery", "delivery")


ORACLES["delivery_contract_violations"] = _delivery_violations_sql()

# J3 without the final de-duplication: the flagship's rows with their multiplicity.
ORACLES["join_composite"] = ORACLES["delivery_satisfaction"].replace("SELECT DISTINCT cl.", "SELECT cl.", 1)

ORACLES["folder_auto_encoding"] = """
SELECT c_custkey, translate(c_name, 'uo', 'úõ') AS name, CASE c_nationkey % 5 WHEN 0 THEN 'utf8' WHEN 1 THEN 'cp1252' WHEN 2 THEN 'utf16'
       WHEN 3 THEN 'nul' ELSE 'utf16le' END AS origin,
       CASE c_nationkey % 5 WHEN 1 THEN c_mktsegment || ' – x' ELSE c_mktsegment END AS segment
FROM customer
"""

_LINE = "CAST(c_custkey AS VARCHAR) || ';' || c_name"
ORACLES["csv_malformed"] = f"""
SELECT c_custkey,
  CASE WHEN c_nationkey % 3 = 1 THEN NULL ELSE c_name END AS name,
  CASE WHEN c_nationkey % 3 IN (1, 2) THEN NULL ELSE c_mktsegment END AS segment,
  CASE c_nationkey % 3 WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN {_LINE} END AS line
FROM customer WHERE c_nationkey % 4 <> 0
UNION ALL
SELECT c_custkey, c_name, c_mktsegment, {_LINE} || ';' || c_mktsegment || ';surplus' FROM customer WHERE c_nationkey % 4 = 0
"""

ORACLES["csv_pick_and_infer"] = f"""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS line FROM customer
UNION ALL SELECT CAST(c_custkey AS INTEGER), c_name, c_acctbal, replace({_LINE}, ';', '|') || '|' || CAST(c_acctbal AS VARCHAR) || '|surplus' FROM customer WHERE c_custkey % 10 = 3
UNION ALL SELECT CAST(c_custkey AS INTEGER), c_name, NULL, replace({_LINE}, ';', '|') FROM customer WHERE c_custkey % 10 = 3
"""

ORACLES["sql_limit"] = """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 50
"""

ORACLES["reconciliation_counts"] = f"SELECT side, COUNT(*) AS unmatched FROM ({ORACLES['reconciliation']}) GROUP BY side"

ORACLES["csv_multiline"] = """
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS line,
  CASE o_orderstatus
    WHEN 'F' THEN o_orderpriority || chr(10) || 'said "yes; no"' || chr(10) || chr(10) || ';' || o_orderstatus
    WHEN 'O' THEN '5" disk ' || o_orderpriority
    ELSE '"' || chr(10) || '"' || chr(10) || o_orderpriority END AS note
FROM orders
"""

_WORDS = """
SELECT c_custkey, c_nationkey % 5 AS kind, translate(substring(h, 1, 8), '0123456789abcdef', 'bcdfglmnprstaeio') AS one,
       translate(substring(h, 9, 10), '0123456789abcdef', 'bcdfglmnprstaeio') AS two
FROM (SELECT *, md5(CAST(c_custkey AS VARCHAR)) AS h FROM customer)
"""
_TITLE = "upper(substring({0}, 1, 1)) || substring({0}, 2)"
_ONE, _TWO = _TITLE.format("one"), _TITLE.format("two")
_SPELLED = f"""
WITH words AS ({_WORDS}),
spelled AS (
  SELECT 'registry' AS side, 'Banco ' || {_ONE} || ' ' || {_TWO} || ' S.A.' AS name, 'banco' || one || two || 's.a.' AS name_norm FROM words
  UNION
  SELECT 'claims',
    CASE kind WHEN 0 THEN 'BÁNCO ' || upper(one) || ' ' || upper(two) || ' S.A.'
              WHEN 1 THEN 'Banco ' || {_ONE} || ' ' || substring({_TWO}, 1, 4) || 'x' || substring(two, 6) || ' S.A.'
              WHEN 2 THEN 'Banco ' || {_ONE} || ' S.A.' WHEN 3 THEN 'Bco ' || {_ONE} || ' ' || {_TWO}
              ELSE 'Banco ' || {_ONE} || ' ' || {_TWO} || ' S.A. Múltiplo' END,
    CASE kind WHEN 0 THEN 'banco' || one || two || 's.a.' WHEN 1 THEN 'banco' || one || substring(two, 1, 4) || 'x' || substring(two, 6) || 's.a.'
              WHEN 2 THEN 'banco' || one || 's.a.' WHEN 3 THEN 'bco' || one || two ELSE 'banco' || one || two || 's.a.multiplo' END
  FROM words),
report AS (SELECT * FROM spelled QUALIFY min(side) OVER (PARTITION BY name_norm) = max(side) OVER (PARTITION BY name_norm))
"""
ORACLES["reconciliation_spelling"] = f"{_SPELLED} SELECT * FROM report"

# Every name of one side with every name of the other.
ORACLES["name_proposals"] = f"""{_SPELLED},
grams AS (SELECT *, list_distinct(list_transform(range(1, greatest(length(name_norm) - 1, 2)), lambda i: substring(name_norm, i, 3))) AS g FROM report)
SELECT left_name, right_name, CAST(100 * o // (m + n - o) AS INTEGER) AS match_percent
FROM (SELECT l.name AS left_name, r.name AS right_name, len(l.g) AS m, len(r.g) AS n, len(list_intersect(l.g, r.g)) AS o
      FROM grams l, grams r WHERE l.side = 'claims' AND r.side = 'registry')
WHERE 100 * o >= 45 * (m + n - o)
"""

ORACLES["parquet_overwrite_period"] = """
SELECT o_orderkey, o_custkey, CASE WHEN last THEN 'R' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN last THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter
FROM (SELECT *, date_trunc('quarter', o_orderdate) = max(date_trunc('quarter', o_orderdate)) OVER () AS last FROM orders)
"""
ORACLES["batch_append"] = """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, 'status-' || o_orderstatus AS batch, COUNT(*) OVER (PARTITION BY o_orderstatus) AS total FROM orders
"""
ORACLES["delivery_incremental"] = ORACLES["delivery_satisfaction"]

ORACLES["name_key_scripts"] = f"""
SELECT c_custkey, sha1(cyr) AS as_cyrillic_key, sha1(cyr) AS cyrillic_key, sha1(gr) AS as_greek_key, sha1(gr) AS greek_key, cyrillic_in_latin
FROM (SELECT c_custkey, replace(one || two, 'c', 'ts') AS cyr, replace(replace(one || two, 'c', 'ch'), 'f', 'ph') AS gr,
             upper(left(a, 1)) || substring(a, 2) || ' ' || upper(left(b, 1)) || substring(b, 2) AS cyrillic_in_latin
      FROM (SELECT *, replace(one, 'c', 'ts') AS a, replace(two, 'c', 'ts') AS b FROM ({_WORDS})))
"""

ORACLES["delivery_bucketed"] = ORACLES["delivery_satisfaction"]
