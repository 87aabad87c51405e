"""SQL surface.

The cleaners are also offered as SQL functions (``CREATE TEMPORARY FUNCTION
... RETURN <expr>``).  A SQL function's body is an ordinary expression, so the
optimizer inlines it into the calling projection: no Python worker, no
per-row call overhead, same plan as the DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.contracts import SQL_CLAIM_COLUMNS, SQL_PROFILE_COLUMNS
from medallion.functions.scripts import to_latin_sql
from medallion.functions.unaccent import MULTI_LETTER, translate_table
from medallion.functions.casts import DECIMAL_TEXT
from medallion.functions.text import CONGLOMERATE_MARKER, ORDINAL_SIGN, PRUDENTIAL_MARKER_PATTERN, UNICODE_SPACES, WHITESPACE


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unaccent_sql(arg: str) -> str:
    src, dst = translate_table()
    expr = f"translate({to_latin_sql(arg, _lit)}, {_lit(src)}, {_lit(dst)})"
    for k, v in MULTI_LETTER.items():
        expr = f"replace({expr}, {_lit(k)}, {_lit(v)})"
    return expr


def sql_function_bodies() -> dict[str, tuple[str, str, str]]:
    """name -> (parameter list, return type, body)."""
    norm = f"translate(lower({unaccent_sql('s')}), {_lit(WHITESPACE)}, '')"
    bare = f"nullif(translate(s, {_lit(WHITESPACE + UNICODE_SPACES)}, ''), '')"
    number = "trim(replace(replace(replace(s, '.', ''), ',', '.'), ' ', ''))"
    return {
        "md_unaccent": ("s STRING", "STRING", unaccent_sql("s")),
        "md_name_norm": ("s STRING", "STRING", norm),
        "md_name_key": ("s STRING", "STRING", f"sha1({norm})"),
        "md_blank_to_null": ("s STRING", "STRING", f"CASE WHEN {bare} IS NOT NULL THEN s END"),
        "md_pad_id": ("s STRING", "STRING", f"lpad({bare}, greatest(length({bare}), 8), '0')"),
        "md_locale_decimal": ("s STRING", "DOUBLE",
                              f"CASE WHEN {number} RLIKE {_lit(DECIMAL_TEXT)} THEN try_cast({number} AS DOUBLE) END"),
        "md_strip_conglomerate": ("s STRING", "STRING", f"replace(s, {_lit(CONGLOMERATE_MARKER)}, '')"),
        "md_strip_prudential": ("s STRING", "STRING", f"regexp_replace(s, {_lit(PRUDENTIAL_MARKER_PATTERN)}, '')"),
        "md_drop_ordinal": ("s STRING", "STRING", f"replace(s, {_lit(ORDINAL_SIGN)}, '')"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the cleaners callable from Spark SQL in this session."""
    names = []
    for name, (params, ret, body) in sql_function_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
        names.append(name)
    return names


def register_views(views: dict[str, DataFrame]) -> None:
    """V1: name DataFrames for SQL."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def delivery_sql() -> str:
    """The statement of the SQL variant: its columns come from the contracts."""
    columns = [*(f"claim.{c}" for c in SQL_CLAIM_COLUMNS), "registry.segment", *(f"profile.{c}" for c in SQL_PROFILE_COLUMNS)]
    return (f"SELECT {', '.join(columns)} FROM {{claims}} AS claim "
            "JOIN {profiles} AS profile USING (sk_financial_institution_name) JOIN {institutions} AS registry ON registry.cnpj = claim.cnpj")


def delivery_satisfaction_sql(spark: SparkSession, claims: DataFrame, institutions: DataFrame,
                              profiles: DataFrame) -> DataFrame:
    """The SQL variant of the delivery table (name key only, no distinct).

    DataFrames are passed to ``spark.sql`` by name (V4), the way the reference
    refers to an in-memory frame by its variable name inside SQL.
    """
    return spark.sql(delivery_sql(), claims=claims, institutions=institutions, profiles=profiles)
