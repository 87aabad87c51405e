"""Operators on literal rows: dedup survivors, anti-join null handling, unions, quality."""

from pyspark.sql import functions as F

from medallion.contracts import Field, TableContract
from medallion.operators import dedup, joins, quality
from medallion.operators.project import column_difference, keep_only
from medallion.operators.union import union_all_by_name


def test_first_by_keeps_declared_survivor(spark):
    df = spark.createDataFrame(
        [("A", "S1", 60, 5), ("A", "S1", 100, 1), ("A", "S1", 100, 9), ("B", None, 70, 1), ("B", None, 10, 1)],
        "name string, seg string, match int, reviews int")
    out = dedup.first_by(df, ["name", "seg"], [F.col("match").desc(), F.col("reviews").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [("A", "S1", 100, 9), ("B", None, 70, 1)]


def test_anti_join_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    null_safe = sorted(r["k"] for r in joins.anti_join(left, right, "k").collect())
    plain = sorted((r["k"] for r in joins.anti_join(left, right, "k", null_safe=False).collect()),
                   key=lambda v: (v is None, v))
    assert null_safe == [1]                 # pandas isin: NaN is a member
    assert plain == [1, None]               # SQL: a null key matches nothing


def test_union_all_by_name_fills_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y")], "id int, b string")
    out = union_all_by_name([a, b, a])
    assert out.count() == 3 and set(out.columns) == {"id", "a", "b"}


def test_column_difference_is_ordered(spark):
    left = spark.createDataFrame([(1, 2, 3, 4)], "d int, c int, b int, a int")
    right = spark.createDataFrame([(1,)], "c int")
    assert column_difference(left, right, keep=["c"]) == ["d", "b", "a", "c"]
    assert keep_only(left, ["a", "d"]).columns == ["a", "d"]


def test_quality_rules_one_pass(spark):
    contract = TableContract("t", (Field("x", "x", max_length=3, nullable=False), Field("y", "y", "bigint")))
    df = spark.createDataFrame([("abcd", "1"), (None, "x"), ("ab", " ")], "x string, y string")
    typed = df.select("x", F.col("y").try_cast("bigint").alias("y"))
    v = {(r["column_name"], r["rule"]): r["violations"] for r in quality.contract_violations(typed, contract).collect()}
    assert v == {("x", "not_null"): 1, ("x", "max_length"): 1}
    f = {r["column_name"]: r["failures"] for r in quality.cast_failures(df, contract).collect()}
    assert f == {"y": 1}                    # 'x' failed; the blank is absent, not a failure
    pk = quality.pk_violations(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).collect()
    assert [(r["k"], r["occurrences"]) for r in pk] == [(1, 2)]


def test_column_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "i int, s string")
    rows = {r["column_name"]: (r["data_type"], r["non_null"], r["total"]) for r in quality.column_profile(df).collect()}
    assert rows == {"i": ("int", 2, 2), "s": ("string", 1, 2)}


def test_conflicting_targets_take_the_smallest(spark):
    from medallion.functions.text import map_by_join
    from medallion.operators.reconcile import apply_overrides, conflicting

    rows = [("a", "z"), ("a", "b"), ("a", "c"), (None, "x"), ("n", None), ("d", "e"), ("d", "e")]
    df = spark.createDataFrame([("a",), ("d",), ("n",), (None,), ("q",)], "name string")
    for order in (rows, rows[::-1]):
        o = spark.createDataFrame(order, "from_name string, to_name string")
        want = sorted([("b",), ("e",), ("n",), (None,), ("q",)], key=str)
        assert sorted(map(tuple, apply_overrides(df, "name", o).collect()), key=str) == want
        mapping = o.toDF("from_value", "to_value")
        assert sorted(map(tuple, map_by_join(df, "name", mapping).collect()), key=str) == want
        assert [tuple(r) for r in conflicting(o).collect()] == [("a", 3, "b")]


def test_rows_without_a_name_do_not_reach_the_join(spark):
    from medallion.operators.joins import join_on_key
    from medallion.plans import queries as Q
    from tests.conftest import SF_SMALL

    plan = Q.q_join_name_key(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(coalesce(map(" in plan  # the claims' cleaned name, in the scan's own join
    claims, profiles = Q.q_trusted_claims(spark, SF_SMALL), Q.q_trusted_profiles(spark, SF_SMALL).select("sk_financial_institution_name", "segment")
    both = [join_on_key(claims, profiles, "sk_financial_institution_name", source=s) for s in (None, "financial_institution_name")]
    assert both[0].exceptAll(both[1]).count() == 0 and both[0].count() == both[1].count() > 0
