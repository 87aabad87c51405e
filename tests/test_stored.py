"""Tables stored in buckets, and balanced reads of relational tables."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from medallion.plans import queries as Q
from medallion.sinks import bucketed
from medallion.sources.jdbc import balanced_predicates, equi_depth_boundaries

from .conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_delivery_needs_no_exchange(spark):
    before = spark.catalog.listTables()
    df = Q.q_delivery_bucketed(spark, SF_SMALL)
    plan = plan_of(df)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    want = Q.q_delivery_satisfaction(spark, SF_SMALL)
    assert df.exceptAll(want).count() == 0 and df.count() == want.count()
    assert spark.catalog.listTables() == before


def test_hot_ids_are_dealt_over_buckets(spark, tmp_path):
    """An id with a third of all rows fills no bucket; every row meets its match once, repeated rows too."""
    n = 6000
    large = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"), (F.col("id") % 2500).alias("v"))
    large = large.unionByName(spark.createDataFrame([(None, 1)], "k string, v bigint"))
    small = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("k2", "d"), ("none", "e"), (None, "f")], "k string, w string")
    stored = bucketed.write_joinable(spark, str(tmp_path), "hot_ids", large, small, "k", buckets=8)
    try:
        got = bucketed.join_stored(*stored, "k", ["k", "v", "w"])
        want = large.join(small, "k")
        assert got.exceptAll(want).count() == 0 and got.count() == want.count() > n / 3
        once = bucketed.join_stored(*stored, "k", ["k", "v", "w"], distinct=True)
        assert once.exceptAll(large.distinct().join(small, "k")).count() == 0 and once.count() == large.distinct().join(small, "k").count()
        assert "Exchange" not in plan_of(got) and "Exchange" not in plan_of(once)
        sizes = [r["count"] for r in stored[0].groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) < 0.25 * n
    finally:
        for kind in ("large", "small"):
            spark.sql(f"DROP TABLE hot_ids_{kind}")


@pytest.mark.parametrize("values", [
    [1, 2, 2, 2, 2, 2, 2, 2, 9, None, 10, -5, 40], [None, None], [], [7] * 50, list(range(1000)), ["a", "b'c", "", None, "zz", "ä"] * 9])
@pytest.mark.parametrize("parts", [1, 4, 7])
def test_predicates_cover_every_row_once(spark, values, parts):
    kind = "string" if any(isinstance(v, str) for v in values) else "bigint"
    bounds = equi_depth_boundaries(spark.createDataFrame([(v,) for v in values], f"v {kind}"), "v", parts)
    predicates = balanced_predicates("v", bounds)
    assert len(predicates) <= max(parts, 1)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (v {'VARCHAR' if kind == 'string' else 'BIGINT'})")
    if values:
        con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    found = [r[0] for p in predicates for r in con.sql(f"SELECT v FROM t WHERE {p}").fetchall()]
    assert sorted(found, key=repr) == sorted(values, key=repr)


def test_shares_are_equal_however_skewed(spark):
    rnd = random.Random(2)
    values = [int(rnd.paretovariate(0.7)) for _ in range(20_000)]
    bounds = equi_depth_boundaries(spark.createDataFrame([(v,) for v in values], "v bigint").repartition(5), "v", 10)
    edges = [float("-inf"), *bounds, float("inf")]
    shares = [sum(a <= v < b for v in values) for a, b in zip(edges, edges[1:])]
    heaviest = max(values.count(v) for v in set(values))
    assert max(shares) <= len(values) / 10 + heaviest
    with pytest.raises(ValueError):
        balanced_predicates("v", [True])
