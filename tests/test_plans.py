"""Plan checks and properties of the layer jobs."""

import pytest

from medallion.plans import queries as Q
from tests.codegen import largest_method
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_early_equals_late(spark):
    early = Q.q_delivery_satisfaction(spark, SF_SMALL)
    late = Q.q_delivery_satisfaction_late(spark, SF_SMALL)
    assert early.count() > 0
    assert early.exceptAll(late).count() == 0
    assert late.exceptAll(early).count() == 0


def test_flagship_equals_reference_plan_brute_force(spark):
    claims = Q.q_trusted_claims(spark, SF_SMALL)
    inst = Q.q_trusted_institutions(spark, SF_SMALL)
    prof = Q.q_trusted_profiles(spark, SF_SMALL)
    ours = Q.q_delivery_satisfaction(spark, SF_SMALL)
    ref = reference_plan(claims, inst, prof)
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_default_path_has_no_python_udf_and_no_cartesian(spark):
    df = Q.q_delivery_satisfaction(spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in plan_text(df) and "ArrowEvalPython" not in plan_text(df)
    assert "CartesianProduct" not in plan_text(df) and "Join Cross" not in text


def test_row_number_dedup_becomes_group_limit(spark):
    df = Q.q_dedup_row_number(spark, SF_SMALL)
    assert "WindowGroupLimit" in plan_text(df)


def test_overwrite_rerun_is_idempotent(spark):
    a = Q.q_parquet_overwrite(spark, SF_SMALL)
    b = Q.q_parquet_overwrite(spark, SF_SMALL)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_trusted_profiles_one_row_per_key(spark):
    df = Q.q_trusted_profiles(spark, SF_SMALL)
    assert df.groupBy("financial_institution_name", "segment").count().where("count > 1").count() == 0


def test_layered_run_audit_counts(spark, tmp_path):
    from pyspark.sql import functions as F
    from medallion.plans import fixtures
    from medallion.plans.layers import build_raw, run_pipeline

    main, second = fixtures.profiles_raw(spark, SF_SMALL)
    raw = build_raw(main.withColumn("source_file", F.lit("m")), second.withColumn("source_file", F.lit("s")),
                    fixtures.institutions_raw(spark, SF_SMALL), fixtures.claims_raw(spark, SF_SMALL))
    audit = {}
    out = run_pipeline(spark, raw, str(tmp_path / "layers"), audit=audit)
    n = out.count()
    assert audit["delivery.bank_employment_satisfaction"] == n > 0
    assert audit["raw.claims"] == audit["trusted.claims"] == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    first = [tuple(r) for r in out.collect()]
    first = sorted(map(repr, first))
    # a re-run with overwrite into the same folders gives the same table
    again = run_pipeline(spark, raw, str(tmp_path / "layers"))
    assert sorted(repr(tuple(r)) for r in again.collect()) == first


def test_describe_view(spark):
    from medallion.operators.quality import describe
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").createOrReplaceTempView("orders_v")
    rows = {r["col_name"]: r["data_type"] for r in describe(spark, "orders_v").collect()}
    assert rows["o_orderkey"] == "bigint" and rows["o_totalprice"] == "double"


def reference_plan(claims, inst, prof):
    """Brute force on a small fixture: the reference's join order, distinct last."""
    from medallion.contracts import CLAIM_COLUMNS, DELIVERY_COLUMNS, PROFILE_DELIVERY_COLUMNS
    from medallion.functions.keys import document_key

    banks_claims = claims.join(inst.drop("financial_institution_name"), "cnpj")
    employee_claims = claims.join(prof.drop("financial_institution_name", "cnpj"), "sk_financial_institution_name")
    employee_claims = employee_claims.withColumn("sk_cnpj_segment", document_key("cnpj", "segment"))
    employee_claims = employee_claims.select(*PROFILE_DELIVERY_COLUMNS, "sk_cnpj_segment")
    assert set(CLAIM_COLUMNS) <= set(banks_claims.columns)
    return banks_claims.join(employee_claims, "sk_cnpj_segment").distinct().select(*DELIVERY_COLUMNS)


def test_hot_institution_early_equals_late(spark):
    """A third of all claims on one id: the early-distinct plan gives the reference's rows."""
    from pyspark.sql import functions as F
    from medallion.plans import fixtures
    from medallion.plans.layers import delivery_satisfaction, trusted_claims, trusted_institutions, \
        trusted_profiles

    raw = fixtures.claims_raw(spark, SF_SMALL)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot_id = str(orders.groupBy("o_custkey").count().orderBy(F.desc("count"), "o_custkey").first()["o_custkey"])
    raw = raw.withColumn("CNPJ IF", F.when(F.hash("Índice", "Ano", "Categoria") % 3 == 0, F.lit(hot_id))
                         .otherwise(F.col("CNPJ IF")))
    claims = trusted_claims(raw)
    inst = trusted_institutions(fixtures.institutions_raw(spark, SF_SMALL))
    prof = trusted_profiles(Q.raw_profiles(spark, SF_SMALL))
    early = delivery_satisfaction(claims, inst, prof)
    late = reference_plan(claims, inst, prof)
    n = early.count()
    assert n > 0
    hot = early.where(F.col("cnpj") == F.lpad(F.lit(hot_id), 8, "0")).count()
    assert hot > n / 10
    assert early.exceptAll(late).count() == 0 and late.exceptAll(early).count() == 0


def test_distinct_aggregates_partially_before_shuffle(spark):
    df = Q.q_delivery_satisfaction(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial HashAggregate below each distinct's exchange (map-side combine)
    assert plan.count("HashAggregate") >= 4


def test_period_query_prunes_claim_partitions(spark, tmp_path):
    """Trusted claims are partitioned by year and quarter; a period filter prunes files."""
    from pyspark.sql import functions as F
    from medallion.plans.layers import trusted_claims
    from medallion.plans import fixtures
    from medallion.sinks.parquet import write_layer

    claims = trusted_claims(fixtures.claims_raw(spark, SF_SMALL))
    root = str(tmp_path / "lake")
    write_layer(claims, root, "trusted", "claims", partition_by=["year_claim", "quarter_claim"])
    df = (spark.read.schema(claims.schema).parquet(f"{root}/trusted/claims")
          .where((F.col("year_claim") == "1998") & (F.col("quarter_claim") == 4))
          .select("cnpj", "bank_index"))
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(year_claim" in plan and "quarter_claim" in plan
    assert "ReadSchema: struct<cnpj:string,bank_index:double>" in plan
    expected = claims.where((F.col("year_claim") == "1998") & (F.col("quarter_claim") == 4)).count()
    assert df.count() == expected > 0


def test_name_key_is_computed_once_for_each_claim(spark):
    """No not-null filter repeats the key's expression below the projection of the claims."""
    from medallion.operators.joins import join_on_key

    claims, profiles = Q.q_trusted_claims(spark, SF_SMALL), Q.q_trusted_profiles(spark, SF_SMALL)
    keys = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("sha1(")
    profile_key = profiles.select("sk_financial_institution_name")
    alone, plain = keys(claims), keys(claims.join(profile_key, "sk_financial_institution_name"))
    joined = keys(join_on_key(claims, profile_key, "sk_financial_institution_name"))
    assert alone == 1 and plain - keys(profile_key) == 2 and joined - keys(profile_key) == 1


def test_flagship_computes_each_key_once_a_branch(spark):
    """Claims are read by two branches (pairs and rows): one name key in each, and none in a filter."""
    plan = Q.q_delivery_satisfaction(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha1(") <= 8


@pytest.mark.parametrize("name", ["trusted_claims", "trusted_profiles", "trusted_institutions", "join_id", "join_name_key", "delivery_satisfaction", "founded_year"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    """HotSpot leaves methods of more than 8,000 bytes uncompiled."""
    assert 0 < largest_method(Q.QUERIES[name](spark, SF_SMALL)) < 8000


def test_late_distinct_has_parts_by_the_number_of_claims(spark, monkeypatch):
    from medallion.plans import layers

    monkeypatch.setattr(layers, "ROWS_A_TASK", 50)
    claims = Q.q_trusted_claims(spark, SF_SMALL)
    late = Q.q_delivery_satisfaction_late(spark, SF_SMALL)
    assert late.rdd.getNumPartitions() >= claims.count() / 50 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert late.exceptAll(Q.q_delivery_satisfaction(spark, SF_SMALL)).count() == 0
