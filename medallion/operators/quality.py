"""Quality and inspection operators.

Each check is one aggregation pass over its table: the rules become
``sum(when(violation, 1))`` / ``count`` columns of a single ``agg`` (partial
aggregation on every task, one small row to merge), and the wide result is
unpivoted into a long report with ``DataFrame.unpivot``.  Nothing but the
report rows ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.contracts import TableContract
from medallion.functions import text
from medallion.operators.union import union_all_by_name


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def row_count(df: DataFrame, table: str | None = None) -> DataFrame:
    """G1: ``SELECT COUNT(*) AS total``."""
    cols = [F.lit(table).alias("table_name")] if table else []
    return df.agg(F.count(F.lit(1)).alias("total")).select(*cols, "total")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """R2: one audit row per table (all counts computed in one job)."""
    return union_all_by_name([row_count(df, name) for name, df in tables.items()])


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """R2 without a second pass: the count rides on the action that writes ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def column_profile(df: DataFrame) -> DataFrame:
    """G2/R1 (``info()``): per column its type, non-null count and the row count."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(q(c)).alias(f"__nn{i}") for i, c in enumerate(names)],
    )
    long = wide.unpivot("__rows", [f"__nn{i}" for i in range(len(names))], "__slot", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f"__nn{i}", i, c, t) for i, (c, t) in enumerate(df.dtypes)],
        "__slot string, position int, column_name string, data_type string",
    )
    return long.join(types, "__slot").select(
        "position", "column_name", "data_type",
        F.col("non_null").cast("bigint").alias("non_null"),
        F.col("__rows").cast("bigint").alias("total"),
    )


def describe(spark: SparkSession, view: str) -> DataFrame:
    """``DESCRIBE view`` as a DataFrame (col_name, data_type, comment)."""
    return spark.sql(f"DESCRIBE `{view}`")


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (null keys count as a value)."""
    return (
        df.groupBy(*[q(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def _rules(contract: TableContract, df: DataFrame) -> list[tuple[str, str, Column]]:
    """(column, rule, condition of a violation).

    A numeric field that is still text breaks ``numeric`` when the text is no number;
    one that is typed does when it does not fit its declared decimal.
    """
    types = dict(df.dtypes)
    rules = []
    for f in contract.fields:
        if f.name not in types:
            continue
        c = q(f.name)
        if not f.nullable:
            rules.append((f.name, "not_null", c.isNull()))
        if f.dtype == "string":
            if f.max_length is not None:
                rules.append((f.name, "max_length", F.length(c) > f.max_length))
        elif types[f.name] == "string":
            rules.append((f.name, "numeric", (text.without_blanks(c) != F.lit("")) & f.value(c).isNull()))
        elif f.decimal is not None:
            digits, scale = f.decimal
            rules.append((f.name, "numeric", F.abs(F.round(c, scale)) >= F.lit(10 ** (digits - scale))))
    return rules


def contract_violations(df: DataFrame, contract: TableContract, table: str | None = None) -> DataFrame:
    """Rows breaking each not-null / max-length / numeric rule of the contract, in one pass."""
    rules = _rules(contract, df)
    wide = df.agg(*[
        F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"__r{i}")
        for i, (_, _, cond) in enumerate(rules)
    ])
    long = wide.unpivot([], [f"__r{i}" for i in range(len(rules))], "__slot", "violations")
    meta = df.sparkSession.createDataFrame(
        [(f"__r{i}", col, rule) for i, (col, rule, _) in enumerate(rules)],
        "__slot string, column_name string, rule string",
    )
    name = [F.lit(table).alias("table_name")] if table else []
    return long.join(meta, "__slot").select(*name, "column_name", "rule", "violations")


def cast_failures(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Per typed column, raw text that was present but did not survive the cast."""
    typed = [f for f in contract.raw_fields if f.dtype != "string" and f.raw in raw.columns]
    exprs = []
    for i, f in enumerate(typed):
        src = q(f.raw)
        value = f.value(src)
        present = text.without_blanks(src) != F.lit("")
        failed = F.sum(F.when(present & value.isNull(), 1).otherwise(0))
        exprs.append(F.coalesce(failed, F.lit(0)).cast("bigint").alias(f"__f{i}"))
    wide = raw.agg(*exprs)
    long = wide.unpivot([], [f"__f{i}" for i in range(len(typed))], "__slot", "failures")
    meta = raw.sparkSession.createDataFrame(
        [(f"__f{i}", f.name, f.dtype) for i, f in enumerate(typed)],
        "__slot string, column_name string, target_type string",
    )
    return long.join(meta, "__slot").select("column_name", "target_type", "failures")
