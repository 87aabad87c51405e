"""The delivery table kept up to date (Z7, Z5) as batches of claims arrive.

The reference makes the whole delivery table anew on every run.  A new batch of claims can
change delivery rows in two ways only:

* rows of the periods that it has claims of;
* rows of an institution anywhere, if the batch brings a name for its id that matches a profile
  which no earlier claim of that id matched (or if registry or profiles have changed since).

So the *matches* of every id (registry with employees, bounded by institutions and profiles, not by
claims) are kept with the table.  They are worked out from an index of the claims, the distinct
(id, name key, period), which is written with each batch.  Ids whose matches differ from the kept
ones are looked up in the index for the periods in which they have claims.  Only the touched periods
are read from the claims (partition pruning) and replaced in the delivery table (dynamic
partition overwrite); all other files stay as they are.

Every step can be repeated: a batch that is there already is not added again, periods are
replaced whole, and what has been taken up is recorded last, so a refresh that died is simply run again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import CLAIM_COLUMNS, DELIVERY_COLUMNS
from medallion.plans.layers import delivery_matches, employees_of, trusted_claims
from medallion.sinks.batches import committed, create_once, read_batches, write_batch
from medallion.sinks.parquet import in_periods, replace_periods
from medallion.sources.parquet import layer_path

PERIOD = ("year_claim", "quarter_claim")
_INDEX = "cnpj string, sk_financial_institution_name string, year_claim string, quarter_claim int"


def _claims_path(root: str) -> str:
    return layer_path(root, "trusted", "claims")


def _index_path(root: str) -> str:
    return layer_path(root, "trusted", "claims_index")


def _delivery_path(root: str) -> str:
    return layer_path(root, "delivery", "bank_employment_satisfaction")


def _state_path(root: str) -> str:
    return layer_path(root, "delivery", "refreshes")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def add_claims(spark: SparkSession, root: str, batch: str, raw: DataFrame) -> bool:
    """A batch of raw claims into the trusted layer, with its index; False if it was there."""
    claims = trusted_claims(raw).select(*CLAIM_COLUMNS)
    added = write_batch(claims, _claims_path(root), batch, PERIOD)
    stored = read_batches(spark, _claims_path(root), _ddl(claims), [batch])
    index = stored.where("cnpj IS NOT NULL").select(*[c.split()[0] for c in _INDEX.split(", ")]).distinct()
    return write_batch(index, _index_path(root), batch) or added


def _refreshes(spark: SparkSession, root: str) -> list[dict]:
    """What earlier refreshes have taken up, in order."""
    return [json.loads(r["attempt"]) for r in committed(spark, _state_path(root))]


def touched_periods(index: DataFrame, new_batches: list[str], changed_ids: DataFrame) -> list[tuple]:
    """Periods with claims of a new batch, or of an id whose matches have changed; one row for each period."""
    ids = index.join(changed_ids, "cnpj", "left_semi").select(*PERIOD)
    return [tuple(r) for r in index.where(F.col("batch").isin(new_batches)).select(*PERIOD).unionByName(ids).distinct().collect()]


def changed_ids(before: DataFrame, now: DataFrame) -> DataFrame:
    """Ids that have a match on one side only, in one pass over both."""
    both = before.withColumn("__now", F.lit(0)).unionByName(now.withColumn("__now", F.lit(1)))
    kept = [c for c in both.columns if c != "__now"]
    one_side = both.groupBy(*kept).agg(F.min("__now").alias("a"), F.max("__now").alias("b")).where("a = b")
    return one_side.select("cnpj").distinct()


def matches_now(spark: SparkSession, root: str, institutions: DataFrame, profiles: DataFrame) -> DataFrame:
    """The matches of all ids in the index."""
    index = read_batches(spark, _index_path(root), _INDEX)
    return delivery_matches(institutions, employees_of(index.select("cnpj", "sk_financial_institution_name"), profiles))


def refresh_plan(spark: SparkSession, root: str, institutions: DataFrame, profiles: DataFrame,
                 kept: str | None = None) -> tuple[list[tuple], DataFrame, DataFrame]:
    """(touched periods, their delivery rows, the matches now); nothing is written but the matches, to ``kept`` if it is
    given.  They are used several times, and are then worked out once and read from there."""
    index = read_batches(spark, _index_path(root), _INDEX)
    matches = matches_now(spark, root, institutions, profiles)
    if kept:
        matches.write.parquet(kept)
        matches = spark.read.schema(_ddl(matches)).parquet(kept)
    done = _refreshes(spark, root)
    taken = {b for r in done for b in r["batches"]}
    new = [r["batch"] for r in committed(spark, _index_path(root)) if r["batch"] not in taken]
    before = spark.read.schema(_ddl(matches)).parquet(done[-1]["matches"]) if done else matches.limit(0)
    periods = touched_periods(index, new, changed_ids(before, matches))
    claims = read_batches(spark, _claims_path(root), _claims_ddl(), None).drop("batch").where(in_periods(PERIOD, periods))
    rows = claims.distinct().join(matches, "cnpj", "inner").select(*DELIVERY_COLUMNS)
    return periods, rows, matches


def _claims_ddl() -> str:
    from medallion.contracts import CLAIMS

    return ", ".join(f"{f.name} {f.dtype}" for f in CLAIMS.fields)


def refresh_delivery(spark: SparkSession, root: str, institutions: DataFrame, profiles: DataFrame) -> list[tuple]:
    """Bring the delivery table up to date with all batches; the periods that were replaced."""
    kept = f"{layer_path(root, 'delivery', 'matches')}/{uuid.uuid4().hex}"
    periods, rows, _ = refresh_plan(spark, root, institutions, profiles, kept)
    if periods:
        replace_periods(rows, _delivery_path(root), PERIOD, periods)
    done = committed(spark, _state_path(root))
    batches = [r["batch"] for r in committed(spark, _index_path(root))]
    state = json.dumps({"batches": batches, "matches": kept})
    entry = {"batch": f"refresh-{len(done)}", "attempt": state, "rows": len(periods), "sequence": len(done)}
    if not create_once(spark, f"{_state_path(root)}/ledger/{entry['batch']}.json", json.dumps(entry)):
        raise RuntimeError("another refresh of this table has finished in the meantime; run it again")
    return periods


def read_delivery(spark: SparkSession, root: str) -> DataFrame:
    """The delivery table as it stands."""
    from medallion.contracts import DELIVERY

    schema = ", ".join(f"{f.name} {f.dtype}" for f in DELIVERY.fields)
    return spark.read.schema(schema).parquet(_delivery_path(root)).select(*DELIVERY_COLUMNS)
