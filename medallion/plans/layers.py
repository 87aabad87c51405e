"""Layer jobs: raw -> trusted -> delivery.

Trusted tables are one projection each, generated from the table contract
(rename + cleaners + never-throwing casts + surrogate keys), so Catalyst sees
one ``Project`` per table inside whole-stage codegen.

The delivery table (Z5) keeps the reference's meaning exactly -- a claim row
receives a profile when *any* claim with the same id has a name matching that
profile and the profile's segment equals the registry segment of the id -- but
not its plan.  The reference joins claims to profiles, joins the result back to
the claims and only then removes duplicates, producing sum(N^2) rows per id
before the ``distinct``.  Here:

1. ``(cnpj, name key)`` pairs are taken from the claims first (a distinct with
   map-side partial aggregation: a hot id is collapsed on every task before the
   shuffle), so the profile join works on pairs, not on claim rows;
2. both join inputs are de-duplicated before the final join instead of its
   output (``distinct(A join B) == distinct(A) join distinct(B)`` for an inner
   equi-join whose output carries all columns of both sides);
3. every join is left to the planner/AQE: broadcast while a side is under the
   session threshold, sort-merge with skew splitting beyond it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import (
    CLAIM_COLUMNS,
    CLAIMS,
    DELIVERY_COLUMNS,
    INSTITUTIONS,
    PROFILE_DELIVERY_COLUMNS,
    PROFILES,
)
from medallion.functions import text
from medallion.functions.keys import document_key, name_key
from medallion.operators.dedup import first_by
from medallion.operators.joins import join_on_key
from medallion.operators.project import column_difference
from medallion.operators.quality import observed
from medallion.operators.union import union_by_name
from medallion.sinks.parquet import write_layer
from medallion.sources.parquet import read_layer


#: Claims for each task of the late distinct, whose rows are wide.
ROWS_A_TASK = 50_000


def trusted_institutions(raw: DataFrame) -> DataFrame:
    """Registry with padded id and the (id, segment) surrogate key."""
    df = INSTITUTIONS.clean(raw)
    return df.withColumn("sk_cnpj_segment", document_key("cnpj", "segment"))


def profile_survivor_order():
    """W1 tie-break: best match first, then most reviews, then a stable text order."""
    return [
        F.col("match_percent").desc_nulls_last(),
        F.col("reviews_count").desc_nulls_last(),
        F.col("employer_name").asc_nulls_last(),
        F.col("url").asc_nulls_last(),
        F.col("source_file").asc_nulls_last(),
    ]


def trusted_profiles(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Z3: typed profiles, headquarters split, name key, one row per (name, segment)."""
    source = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    hq_text = F.col("`employer-headquarters`") if "employer-headquarters" in raw.columns else F.lit(None).cast("string")
    df = PROFILES.clean(raw, source.alias("source_file"), text.blank_to_null(hq_text).alias("__hq"))
    hq = F.col("__hq")
    df = df.withColumns({
        "headquarters_city": text.split_part_trim(hq, ",", 1),
        "headquarters_country": F.when(hq.contains(","), text.split_part_trim(hq, ",", -1)),
        "sk_financial_institution_name": name_key("financial_institution_name"),
    })
    df = df.select(*PROFILES.names)
    if dedup:
        df = first_by(df, ["financial_institution_name", "segment"], profile_survivor_order())
    return df


def trusted_claims(raw: DataFrame) -> DataFrame:
    """Typed claims with padded id, clean name and the name key."""
    df = CLAIMS.clean(raw)
    return df.withColumn("sk_financial_institution_name", name_key("financial_institution_name"))


def employees_of(named: DataFrame, profiles: DataFrame) -> DataFrame:
    """The employee side of Z5 from the claims' ``cnpj`` and ``sk_financial_institution_name``: their distinct
    pairs joined to the profiles, keyed by ``sha1(id || profile segment)``, with only the profile columns the
    claims side does not have (P6), de-duplicated."""
    prof = profiles.drop("financial_institution_name", "cnpj")
    pairs = named.select("cnpj", "sk_financial_institution_name").where("cnpj IS NOT NULL").distinct()  # one pair an id without a name
    employee = join_on_key(pairs, prof, "sk_financial_institution_name")
    employee = employee.withColumn("sk_cnpj_segment", document_key("cnpj", "segment")).where("segment IS NOT NULL")
    carried = [c for c in column_difference(employee, CLAIM_COLUMNS, keep=["sk_cnpj_segment"])
               if c in PROFILE_DELIVERY_COLUMNS or c == "sk_cnpj_segment"]
    return employee.select(*carried).distinct()


def delivery_matches(institutions: DataFrame, employee: DataFrame) -> DataFrame:
    """Registry and employees of every id: what a claim of that id is joined to."""
    return _registry(institutions).distinct().join(employee, "sk_cnpj_segment", "inner")


def _registry(institutions: DataFrame) -> DataFrame:
    return institutions.select("cnpj", "segment", "sk_cnpj_segment")


def composite_key_join(claims: DataFrame, institutions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Claims-with-registry joined to the employee side on the (id, segment) key.

    The many-to-many join of Z5 before any de-duplication of its output.
    """
    banks_claims = claims.select(*CLAIM_COLUMNS).join(_registry(institutions), "cnpj", "inner")
    employee = employees_of(claims, profiles)
    return banks_claims.join(employee, "sk_cnpj_segment", "inner").select(*DELIVERY_COLUMNS)


def _distinct_in_parts(rows: DataFrame, number: int) -> DataFrame:
    """Distinct rows, dealt out by all columns to as many tasks as ``number`` rows need, so that a task's table of wide rows
    does not grow with the input (a plain distinct has a fixed number of partitions, which AQE can only make fewer)."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-number // ROWS_A_TASK))
    return rows.repartition(parts, *rows.columns).distinct()


def delivery_satisfaction(claims: DataFrame, institutions: DataFrame, profiles: DataFrame,
                          early_distinct: bool = True) -> DataFrame:
    """Claims with their registry segment and the employer profile of their id.

    ``early_distinct=False`` keeps the reference's placement of the final
    ``distinct`` (on the joined output) but not its employee side: the
    reference joins every claim row to the profiles and then to every claim
    row of the same id again -- all pairs of claims within an institution.
    Both forms here build the employee side from distinct ``(id, name key)``
    pairs, so no join emits more rows than the result has before
    de-duplication; they differ only in de-duplicating the join's inputs or its
    output.

    The early form meets registry and employees first (both are bounded by the number of
    institutions and profiles, not of claims), so the claims join once, and their distinct carries
    their own 15 columns only; the join's not-null filter on the id reaches below it.  (A semi-join
    of the claims against the ids that are left was tried: it computes the employee side twice.)
    The distincts aggregate on full rows, so an institution holding a third of all claims is spread over all
    partitions by the aggregate's hash (of the late form, as many as the number of claims asks for, which is counted first); the joins broadcast a side under the session threshold or
    are sort-merge joins whose skewed partitions AQE splits.
    """
    claims = claims.select(*CLAIM_COLUMNS)
    employee = employees_of(claims, profiles)
    if early_distinct:
        out = claims.distinct().join(delivery_matches(institutions, employee), "cnpj", "inner")
    else:
        out = claims.join(_registry(institutions), "cnpj", "inner").join(employee, "sk_cnpj_segment", "inner")
        out = _distinct_in_parts(out, claims.count())
    return out.select(*DELIVERY_COLUMNS)


@dataclass
class RawInputs:
    institutions: DataFrame
    profiles: DataFrame
    claims: DataFrame


def build_raw(profiles_main: DataFrame, profiles_second: DataFrame, institutions: DataFrame,
              claims: DataFrame) -> RawInputs:
    """The raw layer's three tables (profiles: both files unioned by name, D13)."""
    profiles = union_by_name(profiles_main, profiles_second)
    return RawInputs(institutions=institutions, profiles=profiles, claims=claims)


def run_pipeline(spark: SparkSession, raw: RawInputs, root: str, mode: str = "overwrite",
                 audit: dict[str, int] | None = None) -> DataFrame:
    """Raw -> trusted -> delivery, each layer written as parquet and re-read.

    Every layer is materialised in the shared ``root`` and the next layer reads
    the written files, so lineage is cut at each layer and a lost executor
    only recomputes the current layer.  Claims are partitioned by year and
    quarter so that period queries prune files.
    """
    observations = []

    def write(df: DataFrame, layer: str, table: str, **kwargs) -> None:
        # R2: the row count rides on the write itself (no second pass).
        df, obs = observed(df, f"{layer}.{table}")
        write_layer(df, root, layer, table, mode=mode, **kwargs)
        observations.append((f"{layer}.{table}", obs))

    def write_all(*jobs: tuple) -> None:
        # The tables of one layer are independent jobs: submit them together so
        # the scheduler can run their tasks side by side.
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(write, *job[:3], **(job[3] if len(job) > 3 else {})) for job in jobs]:
                f.result()

    write_all(
        (raw.institutions, "raw", "institutions"),
        (raw.profiles, "raw", "profiles"),
        (raw.claims, "raw", "claims"),
    )

    inst = trusted_institutions(read_layer(spark, root, "raw", "institutions"))
    prof = trusted_profiles(read_layer(spark, root, "raw", "profiles"))
    claims = trusted_claims(read_layer(spark, root, "raw", "claims"))
    write_all(
        (inst, "trusted", "institutions"),
        (prof, "trusted", "profiles"),
        (claims, "trusted", "claims", {"partition_by": ["year_claim", "quarter_claim"]}),
    )

    # Partition values come back typed by inference; the written schema keeps
    # ``year_claim`` text.
    trusted_claims_df = spark.read.schema(claims.schema).parquet(f"{root.rstrip('/')}/trusted/claims")
    delivery = delivery_satisfaction(
        trusted_claims_df.select(*CLAIM_COLUMNS),
        read_layer(spark, root, "trusted", "institutions"),
        read_layer(spark, root, "trusted", "profiles"),
    )
    write(delivery, "delivery", "bank_employment_satisfaction")
    if audit is not None:
        audit.update({name: int(obs.get["rows"]) for name, obs in observations})
    return read_layer(spark, root, "delivery", "bank_employment_satisfaction").select(*DELIVERY_COLUMNS)
