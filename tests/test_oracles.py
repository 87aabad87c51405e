"""Every registered query against its DuckDB oracle on the smallest tables."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from medallion.plans.queries import QUERIES as CORE
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


# Spark type name -> DuckDB type name of the same values.
SAME_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def norm(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    assert name in ORACLES, f"{name} has no oracle"
    rel = duck.sql(ORACLES[name])
    ocols = rel.columns
    assert sorted(cols) == sorted(ocols)
    otypes = dict(zip(ocols, (str(t) for t in rel.types)))
    assert {c: SAME_TYPE.get(t, t) for c, t in df.dtypes} == otypes
    order = sorted(cols)
    a = Counter(tuple(norm(r[c]) for c in order) for r in rows)
    b = Counter(tuple(norm(r[ocols.index(c)]) for c in order) for r in rel.fetchall())
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 38
