"""K6-K9: publishing a layer to a relational target over JDBC.

The reference inserts the delivery table one row at a time from the driver
(K8) or appends a whole frame in one transaction (K6).  Here every write is a
distributed, batched JDBC write from the executors: ``num_partitions``
connections, ``batchsize`` rows per round trip, column types declared from the
contract when Spark creates the table (K9), and ``truncate`` on overwrite so the
target's definition survives a re-run (K7).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from medallion.contracts import TableContract

_SQL_TYPES = {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE"}


def contract_column_types(contract: TableContract, decimals: bool = True) -> dict[str, str]:
    """K9: column types from a contract, as Spark's DDL parser takes them.

    Text with a length is VARCHAR(n), other text STRING (a relational target gets
    its own unbounded text type for it); ``decimals`` uses the declared decimals.
    """
    out = {}
    for f in contract.fields:
        if f.dtype == "string":
            out[f.name] = f"VARCHAR({f.max_length})" if f.max_length else "STRING"
        elif decimals and f.decimal:
            out[f.name] = "DECIMAL({}, {})".format(*f.decimal)
        else:
            out[f.name] = _SQL_TYPES.get(f.dtype, f.dtype.upper())
    return out


def create_table_column_types(types: Mapping[str, str]) -> str:
    """K9: the ``createTableColumnTypes`` option, ``"a VARCHAR(4), b VARCHAR(8)"``."""
    return ", ".join(f"{name} {sql_type}" for name, sql_type in types.items())


def jdbc_write_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
    column_types: Mapping[str, str] | None = None,
    truncate: bool = True,
    isolation_level: str = "READ_COMMITTED",
) -> dict[str, str]:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
        "isolationLevel": isolation_level,
    }
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if column_types:
        opts["createTableColumnTypes"] = create_table_column_types(column_types)
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """K6 (``append``) / K7 (``overwrite`` + truncate).

    Appending the same batch twice doubles the rows; re-runs should use
    ``overwrite`` (truncate keeps the table definition) or carry a batch column.
    """
    if mode not in {"append", "overwrite", "errorifexists", "ignore"}:
        raise ValueError(f"unsupported JDBC save mode {mode!r}")
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **kwargs)).mode(mode).save()
