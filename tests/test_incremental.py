"""Batches, replaced periods, and the delivery table kept up to date by them."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from medallion.contracts import DELIVERY_COLUMNS
from medallion.plans import fixtures, incremental
from medallion.plans.layers import delivery_satisfaction, trusted_claims, trusted_institutions, trusted_profiles
from medallion.plans.queries import raw_profiles
from medallion.sinks import batches
from medallion.sinks.parquet import in_periods, replace_periods, write_parquet

from .conftest import SF_SMALL


def files(folder):
    return {str(p.relative_to(folder)): os.stat(p).st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_a_batch_counts_once(spark, tmp_path):
    table, rows = str(tmp_path / "t"), spark.range(5).withColumn("p", F.col("id") % 2)
    assert batches.committed(spark, table) == [] and batches.read_batches(spark, table, "id bigint, p bigint").count() == 0
    assert batches.write_batch(rows, table, "one", ["p"]) and batches.write_batch(rows, table, "two", ["p"])
    broken = spark.range(3).select(F.raise_error(F.lit("must not run")).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("p"))
    assert not batches.write_batch(broken, table, "one", ["p"])  # not even computed
    with pytest.raises(Exception, match="must not run"):
        batches.write_batch(broken, table, "three", ["p"])
    spark.range(9).write.parquet(f"{table}/data/batch=four/attempt=dead")  # a run that died before its commit
    got = batches.read_batches(spark, table, "id bigint, p bigint")
    assert sorted((r["batch"], r["id"], r["p"]) for r in got.collect()) == sorted((b, i, i % 2) for b in ("one", "two") for i in range(5))
    assert {tuple(r) for r in batches.batch_counts(spark, table).collect()} == {("one", 5), ("two", 5)}
    assert batches.read_batches(spark, table, "id bigint, p bigint", ["two"]).count() == 5
    assert "PartitionFilters: [isnotnull(p" in got.where("p = 1")._jdf.queryExecution().toString()


def test_one_of_two_runs_wins(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    assert batches.write_batch(spark.range(2), table, "one")
    monkeypatch.setattr(batches, "committed", lambda *_: [])  # the other run began before this commit
    assert not batches.write_batch(spark.range(7), table, "one")
    monkeypatch.undo()
    assert batches.read_batches(spark, table, "id bigint").count() == 2
    with pytest.raises(ValueError):
        batches.write_batch(spark.range(1), table, "../elsewhere")


def test_statements_of_one_transaction():
    assert batches.jdbc_batch_statements("dw.sales", "sales_new", "ledger", "2024-q1", ["id", 'odd"name']) == [
        'INSERT INTO "ledger" (batch, total) SELECT \'2024-q1\', COUNT(*) FROM "sales_new"',
        'INSERT INTO "dw"."sales" ("id", "odd""name") SELECT "id", "odd""name" FROM "sales_new"',
    ]
    with pytest.raises(ValueError):
        batches.jdbc_batch_statements("t", "s", "l", "x'; DROP TABLE t --", ["id"])


def test_statements_run_as_one_transaction():
    """The same text against an in-process database: a second run fails as a whole."""
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE ledger (batch VARCHAR PRIMARY KEY, total BIGINT); CREATE TABLE t (id BIGINT); CREATE TABLE s AS SELECT range AS id FROM range(3)")
    for run in range(2):
        con.execute("BEGIN")
        try:
            for sql in batches.jdbc_batch_statements("t", "s", "ledger", "one", ["id"]):
                con.execute(sql)
            con.execute("COMMIT")
        except duckdb.ConstraintException:
            con.execute("ROLLBACK")
            assert run == 1
    assert con.sql("SELECT count(*) FROM t").fetchall() == [(3,)] and con.sql("SELECT * FROM ledger").fetchall() == [("one", 3)]


def test_only_one_period_is_replaced(spark, tmp_path):
    table = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("y"), F.when(F.col("id") % 5 < 4, F.concat(F.lit("q/"), F.col("id") % 5)).alias("q"))
    path = write_parquet(table, str(tmp_path / "t"), partition_by=["y", "q"])
    before = files(path)
    new = table.where("y = 1 and q = 'q/2'").withColumn("id", -F.col("id"))
    for _ in range(2):  # running it again changes nothing
        replace_periods(new, path, ["y", "q"], [(1, "q/2")])
        want = table.withColumn("id", F.when((F.col("y") == 1) & (F.col("q") == "q/2"), -F.col("id")).otherwise(F.col("id")))
        assert sorted(map(str, spark.read.schema(table.schema).parquet(path).collect())) == sorted(map(str, want.collect()))
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.rsplit("/", 1)[0] for f in set(before) - same} == {"y=1/q=q%2F2"} and len(same) == len(before) - 1


def test_listed_periods_are_emptied_and_others_refused(spark, tmp_path):
    table = spark.range(20).select("id", (F.col("id") % 2).cast("int").alias("y"), F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("q"))
    path = write_parquet(table, str(tmp_path / "t"), partition_by=["y", "q"])
    before = files(path)
    with pytest.raises(Exception, match="not to be replaced: 1 2"):
        replace_periods(table.where("y = 1 and q in ('1', '2')"), path, ["y", "q"], [(1, "1")])
    assert files(path) == before
    replace_periods(table.where("y = 1 and q = '1'"), path, ["y", "q"], [(1, "1"), (0, None), (0, "2")])
    got = spark.read.schema(table.schema).parquet(path)
    assert got.exceptAll(table.where("not (y = 0 and (q is null or q = '2'))")).count() == 0
    assert got.where(in_periods(["y", "q"], [(0, None), (0, "2")])).count() == 0 and got.where("y = 0 and q = '1'").count() > 0


@pytest.fixture(scope="module")
def sources(spark):
    claims = fixtures.claims_raw(spark, SF_SMALL).checkpoint()
    registry = trusted_institutions(fixtures.institutions_raw(spark, SF_SMALL)).checkpoint()
    profiles = trusted_profiles(raw_profiles(spark, SF_SMALL)).checkpoint()
    return claims, registry, profiles


def same_rows(a, b):
    return a.select(*DELIVERY_COLUMNS).exceptAll(b.select(*DELIVERY_COLUMNS)).count() == 0 and a.count() == b.count()


@pytest.mark.parametrize("seed", range(2))
def test_steps_equal_the_full_run(spark, sources, tmp_path, seed):
    """Random batches, some of whose ids are known and some new, sent again, and refreshed at random."""
    claims, registry, profiles = sources
    rnd, root = random.Random(seed), str(tmp_path / "lake")
    part = F.pmod(F.xxhash64(*claims.columns, F.lit(seed)), F.lit(4))
    sent = set()
    for i in [0, 1, 0, 2, 3, 1]:
        incremental.add_claims(spark, root, f"b{i}", claims.where(part == i))
        sent.add(i)
        if rnd.random() < 0.6 or len(sent) == 4:
            incremental.refresh_delivery(spark, root, registry, profiles)
            want = delivery_satisfaction(trusted_claims(claims.where(part.isin(*sent))), registry, profiles)
            assert same_rows(incremental.read_delivery(spark, root), want)
    assert incremental.refresh_delivery(spark, root, registry, profiles) == []


def test_a_batch_touches_its_periods_and_those_of_changed_ids(spark, sources, tmp_path):
    claims, registry, profiles = sources
    root = str(tmp_path / "lake")
    some = claims.select("Ano", "Trimestre").distinct().orderBy("Ano", "Trimestre").collect()
    late = (F.col("Ano") == some[1]["Ano"]) & (F.col("Trimestre") == some[1]["Trimestre"])
    incremental.add_claims(spark, root, "others", claims.where(~late))
    incremental.refresh_delivery(spark, root, registry, profiles)
    before = files(tmp_path / "lake/delivery/bank_employment_satisfaction")
    # claims of names that are known: only their own period is read and replaced
    known = claims.where(~late).withColumns({"Ano": F.lit(some[1]["Ano"]), "Trimestre": F.lit(some[1]["Trimestre"])})
    incremental.add_claims(spark, root, "known-names", known)
    periods, rows, _ = incremental.refresh_plan(spark, root, registry, profiles)
    assert periods == [(some[1]["Ano"], int(some[1]["Trimestre"][0]))]
    plan = rows._jdf.queryExecution().toString()
    claim_scans = [line for line in plan.splitlines() if "FileScan" in line and "bank_index" in line]
    assert claim_scans and all("PartitionFilters: [" in line and "year_claim" in line.split("PartitionFilters: [")[1].split("]")[0] for line in claim_scans)
    assert incremental.refresh_delivery(spark, root, registry, profiles) == periods
    after = files(tmp_path / "lake/delivery/bank_employment_satisfaction")
    touched = f"year_claim={periods[0][0]}/quarter_claim={periods[0][1]}"
    assert all(after.get(f) == t for f, t in before.items() if not f.startswith(touched))
    # a name that is new for an id makes a profile match: all periods of that id are made anew
    one = claims.where(F.trim("CNPJ IF") != "").join(registry.select("cnpj", F.col("segment").alias("of")), F.lpad(F.trim("CNPJ IF"), 8, "0") == F.col("cnpj"))
    one = one.join(profiles.select("segment", F.col("financial_institution_name").alias("other")), F.col("segment") == F.col("of"))
    brings = one.orderBy("cnpj", F.desc("other")).limit(1).withColumn("Instituição financeira", F.col("other")).select(*claims.columns).checkpoint()
    incremental.add_claims(spark, root, "new-name", brings)
    assert len(incremental.refresh_delivery(spark, root, registry, profiles)) > 1
    want = delivery_satisfaction(trusted_claims(claims.where(~late).unionByName(known).unionByName(brings)), registry, profiles)
    assert same_rows(incremental.read_delivery(spark, root), want)


def test_changed_profiles_change_their_ids_only(spark, sources, tmp_path):
    """A profile that goes and one that comes: the periods of the ids that they match are made anew, emptied ones too."""
    claims, registry, profiles = sources
    root = str(tmp_path / "lake")
    incremental.add_claims(spark, root, "all", claims)
    incremental.refresh_delivery(spark, root, registry, profiles.where("segment != 'BUILDING'"))
    periods = incremental.refresh_delivery(spark, root, registry, profiles.where("segment != 'MACHINERY'"))
    assert periods
    assert same_rows(incremental.read_delivery(spark, root), delivery_satisfaction(trusted_claims(claims), registry, profiles.where("segment != 'MACHINERY'")))
    incremental.refresh_delivery(spark, root, registry, profiles.limit(0))
    assert incremental.read_delivery(spark, root).count() == 0


def test_a_refresh_that_died_is_run_again(spark, sources, tmp_path, monkeypatch):
    claims, registry, profiles = sources
    root = str(tmp_path / "lake")
    incremental.add_claims(spark, root, "all", claims)
    monkeypatch.setattr(incremental, "create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        incremental.refresh_delivery(spark, root, registry, profiles)
    monkeypatch.undo()
    assert incremental.refresh_delivery(spark, root, registry, profiles)
    assert same_rows(incremental.read_delivery(spark, root), delivery_satisfaction(trusted_claims(claims), registry, profiles))


def test_matches_are_worked_out_once_a_refresh(spark, sources, tmp_path):
    """The delivery rows and the changed ids are made from the kept matches, not from the index and the profiles again."""
    claims, registry, profiles = sources
    root, kept = str(tmp_path / "lake"), str(tmp_path / "kept")
    incremental.add_claims(spark, root, "all", claims)
    periods, rows, matches = incremental.refresh_plan(spark, root, registry, profiles, kept)
    now = incremental.matches_now(spark, root, registry, profiles)
    assert periods and matches.count() == now.count() > 0 and matches.exceptAll(now).count() == 0
    read = set(rows.inputFiles())
    assert read and all("/kept/" in f or "/trusted/claims/" in f for f in read) and any("/kept/" in f for f in read)
