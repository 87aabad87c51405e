"""Table contracts: one ordered list of fields per table.

A contract generates the raw read schema (all text, raw header names), the
rename, the cleaning + casting projection (one ``select``), the data-quality
rules (not-null, max length, numeric type, primary key) and the final column
order.  The raw header names and the clean names are fixed values: they are the
column names of the source files and of the published tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import casts, text

Cleaner = Callable[[Column], Column]

#: Columns of one number type from which they are cast together.
TOGETHER = 3


@dataclass(frozen=True)
class Field:
    raw: str | None          # header name in the source file (None: derived column)
    name: str                # clean name
    dtype: str = "string"    # Spark SQL type name of the trusted column
    clean: Cleaner | None = None
    nullable: bool = True
    max_length: int | None = None
    decimal: tuple[int, int] | None = None  # digits and scale of the published column

    def value(self, source: Column) -> Column:
        """The trusted value of a raw column: cleaner, then the never-throwing cast.

        Whole numbers also come as float text (``'12345.0'``) and are read as such.
        """
        return self.typed(self.cleaned(source))

    def cleaned(self, source: Column) -> Column:
        """The text that is to be cast."""
        return source if self.clean is None else self.clean(source)

    def typed(self, c: Column) -> Column:
        """The never-throwing cast of cleaned text; text cut at its point has whole numbers only."""
        if self.dtype == "int" and self.clean is text.cut_decimals:
            return casts.to_int(c)
        if self.dtype == "bigint":
            return casts.float_text_to_long(c)
        if self.dtype == "int":
            return casts.float_text_to_int(c)
        return c if self.dtype == "string" else casts.try_cast_to(c, self.dtype)


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    sep: str = ","
    encoding: str = "UTF-8"

    @property
    def raw_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.raw is not None)

    @property
    def raw_names(self) -> list[str]:
        return [f.raw for f in self.raw_fields]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.raw_names])

    def rename_map(self) -> dict[str, str]:
        return {f.raw: f.name for f in self.raw_fields}

    def types(self) -> dict[str, str]:
        return {f.name: f.dtype for f in self.fields}

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def clean(self, raw: DataFrame, *keep: Column) -> DataFrame:
        """The raw fields renamed, cleaned and cast, with further columns ``keep`` of the raw table.

        Text first, then types.  Numbers of one type are cast as one array by one expression: with an
        expression for each of some ten columns, the generated code of the stage exceeds the
        8,000 bytes a method beyond which the JVM leaves it uncompiled.
        """
        text_of = [(F.col(f"`{f.raw}`") if f.raw in raw.columns else F.lit(None).cast("string")) for f in self.raw_fields]
        alike = {t: [f for f in self.raw_fields if f.dtype == t] for t in ("bigint", "double")}
        together = {f.name: (t, i) for t, fields in alike.items() if len(fields) >= TOGETHER for i, f in enumerate(fields)}
        cleaned = {f.name: f.cleaned(c) for f, c in zip(self.raw_fields, text_of)}
        arrays = [F.transform(F.array(*(cleaned[f.name] for f in alike[t])), alike[t][0].typed).alias(f"__{t}") for t in dict.fromkeys(t for t, _ in together.values())]
        first = raw.select(*(c.alias(n) for n, c in cleaned.items() if n not in together), *arrays, *keep)
        values = (F.get(f"__{together[f.name][0]}", F.lit(together[f.name][1])) if f.name in together else f.typed(F.col(f.name)) for f in self.raw_fields)
        known = {*cleaned, "__bigint", "__double"}
        return first.select(*(v.alias(f.name) for v, f in zip(values, self.raw_fields)), *(c for c in first.columns if c not in known))


# --------------------------------------------------------------------------
# Raw header names of the three sources and their clean names.
# --------------------------------------------------------------------------

INSTITUTIONS = TableContract(
    name="institutions",
    sep="\t",
    fields=(
        Field("Segmento", "segment", max_length=10),
        Field("CNPJ", "cnpj", clean=text.pad_id, max_length=8),
        Field("Nome", "financial_institution_name",
              clean=lambda c: text.blank_to_null(text.strip_prudential(c)), nullable=False, max_length=255),
        Field(None, "sk_cnpj_segment", nullable=True, max_length=40),
    ),
    primary_key=("sk_cnpj_segment",),
)

PROFILE_SCORES = (
    ("Geral", "general_score"),
    ("Cultura e valores", "culture_values_score"),
    ("Diversidade e inclusão", "diversity_inclusion_score"),
    ("Qualidade de vida", "life_quality_score"),
    ("Alta liderança", "senior_leadership_score"),
    ("Remuneração e benefícios", "compensation_benefits_score"),
    ("Oportunidades de carreira", "career_opportunities_score"),
    ("Recomendam para outras pessoas(%)", "recommendation_score"),
    ("Perspectiva positiva da empresa(%)", "company_positive_score"),
)

PROFILES = TableContract(
    name="profiles",
    sep="|",
    fields=(
        Field("employer_name", "employer_name", max_length=255),
        Field("reviews_count", "reviews_count", "bigint"),
        Field("culture_count", "culture_count", "bigint"),
        Field("salaries_count", "salaries_count", "bigint"),
        Field("benefits_count", "benefits_count", "bigint"),
        Field("employer-website", "employer_website", max_length=255),
        Field("employer-headquarters", "employer_headquarters", max_length=255),
        Field("employer-founded", "employer_founded", "int", clean=text.cut_decimals),
        Field("employer-industry", "employer_industry", max_length=255),
        Field("employer-revenue", "employer_revenue", max_length=255),
        Field("url", "url", max_length=255),
        *(Field(raw, clean, "double", decimal=(5, 2)) for raw, clean in PROFILE_SCORES),
        Field("Segmento", "segment", max_length=10),
        Field("CNPJ", "cnpj", clean=text.pad_id, max_length=8),
        Field("Nome", "financial_institution_name", nullable=False, max_length=255),
        Field("match_percent", "match_percent", "int", clean=text.cut_decimals, decimal=(5, 2)),
        Field(None, "headquarters_city"),
        Field(None, "headquarters_country"),
        Field(None, "source_file"),
        Field(None, "sk_financial_institution_name", max_length=40),
    ),
    primary_key=("financial_institution_name", "segment"),
)

# Whole-value aliases applied to claim institution names so they
# match the registry / profile spelling.
BANK_NAME_ALIASES: dict[str, str] = {
    "BB": "BANCO DO BRASIL",
    "DAYCOVAL": "BANCO DAYCOVAL S.A",
    "DEUTSCHE BANK S.A. - BANCO ALEMAO": "DEUTSCHE",
    "BANCO SUMITOMO MITSUI BRASILEIRO S.A.": "BANCO SUMITOMO MITSUI BRASIL S.A.",
}


def claim_name(c: Column) -> Column:
    """Claim institution name: marker stripped, blank -> null, whole-value aliases (blanks around the value don't count)."""
    name = text.blank_to_null(text.strip_conglomerate(c))
    return text.alias_of(text.strip(name), name, BANK_NAME_ALIASES)


# The dash in the three customer-count headers is U+2013; in the cp1252 files
# read as Latin-1 it arrives as U+0096 and is mapped back by
# ``sources.delimited.canonical_header``.
CLAIMS = TableContract(
    name="claims",
    sep=";",
    encoding="windows-1252",
    fields=(
        Field("Ano", "year_claim", nullable=False, max_length=4),
        Field("Trimestre", "quarter_claim", "int", clean=text.drop_ordinal, nullable=False),
        Field("Categoria", "category", max_length=255),
        Field("Tipo", "bank_type", max_length=255),
        Field("CNPJ IF", "cnpj", clean=text.pad_id, max_length=8),
        Field("Instituição financeira", "financial_institution_name", clean=claim_name, nullable=False, max_length=255),
        Field("Índice", "bank_index", "double", clean=text.locale_decimal_text),
        Field("Quantidade de reclamações reguladas procedentes", "number_of_regulated_proceeding_complaints", "bigint"),
        Field("Quantidade de reclamações reguladas - outras", "number_of_regulated_other_complaints", "bigint"),
        Field("Quantidade de reclamações não reguladas", "number_of_unregulated_complaints", "bigint"),
        Field("Quantidade total de reclamações", "total_number_of_complaints", "bigint"),
        Field("Quantidade total de clientes – CCS e SCR", "total_number_of_ccs_and_scr_customers", "bigint",
              clean=text.remove_spaces),
        Field("Quantidade de clientes – CCS", "number_of_ccs_customers", "bigint", clean=text.remove_spaces),
        Field("Quantidade de clientes – SCR", "number_of_scr_customers", "bigint", clean=text.remove_spaces),
        Field(None, "sk_financial_institution_name", max_length=40),
    ),
    primary_key=("financial_institution_name", "year_claim", "quarter_claim"),
)

CLAIM_COLUMNS = [f.name for f in CLAIMS.fields]

# Profile columns carried into the delivery table: those of the raw files that
# the claims/registry side does not already have (FIXTURES §2).
PROFILE_DELIVERY_COLUMNS = [f.name for f in PROFILES.raw_fields if f.name not in {*CLAIM_COLUMNS, "segment"}]

DELIVERY_COLUMNS = [*CLAIM_COLUMNS, "segment", "sk_cnpj_segment", *PROFILE_DELIVERY_COLUMNS]

# The SQL variant's table: claims without their counts, the registry segment, and the
# profile without its names and addresses but with the headquarters in two columns.
SQL_CLAIM_COLUMNS = [f.name for f in CLAIMS.fields if f.dtype != "bigint"]
SQL_PROFILE_COLUMNS = [f.name for f in PROFILES.fields
                       if f.name in {*PROFILE_DELIVERY_COLUMNS, "headquarters_city", "headquarters_country"}
                       and f.name not in {"employer_name", "employer_headquarters", "url"}]


def _fields_by_name() -> dict[str, Field]:
    out: dict[str, Field] = {}
    for contract in (CLAIMS, INSTITUTIONS, PROFILES):
        for f in contract.fields:
            out.setdefault(f.name, f)
    return out


# The published delivery table: its columns take type, length and null rule from
# the source contract they come from (claims first, then registry, then profiles).
DELIVERY = TableContract(
    name="bank_employment_satisfaction",
    fields=tuple(replace(_fields_by_name()[name], raw=None, clean=None) for name in DELIVERY_COLUMNS),
)
