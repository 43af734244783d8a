"""Tables of an external database over JDBC. The driver jar comes with the job."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(url: str, table: str, partition_column: str | None = None, bounds: tuple[object, object] | None = None,
                      partitions: int = 1, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Read options; with a partition column the table is read by ``partitions`` range queries side by side."""
    o = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        o |= {"partitionColumn": partition_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return {**o, **extra}


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def upsert_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """One statement that moves a staging table into its target, last write wins."""
    values = [c for c in columns if c not in keys]
    cols = ", ".join(columns)
    action = f"DO UPDATE SET {', '.join(f'{c} = EXCLUDED.{c}' for c in values)}" if values else "DO NOTHING"
    return f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} ON CONFLICT ({', '.join(keys)}) {action}"


def with_retries(action: Callable[[], None], attempts: int = 3, pause_seconds: float = 1.0) -> None:
    """Run ``action``, again after a growing pause when it fails; the last failure is raised."""
    for i in range(attempts):
        try:
            return action()
        except Exception:
            if i == attempts - 1:
                raise
            time.sleep(pause_seconds * 2 ** i)


def write_jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], execute: Callable[[str], None], batch_rows: int = 5_000,
                      attempts: int = 3, order_by: Sequence[str] = (), **extra: str) -> None:
    """Upsert through a staging table: executors write batches in parallel, then one statement merges.

    ``execute`` runs one SQL statement on the database. The staging table is overwritten by each call, so a
    retried micro-batch has no effect beyond the first.
    """
    from ..operators.dedup import dedup_last
    rows = dedup_last(df, list(keys), list(order_by)) if order_by else df
    staging = f"{table}_staging"

    def once() -> None:
        (rows.write.format("jdbc").mode("overwrite").options(url=url, dbtable=staging, batchsize=str(batch_rows), truncate="true", **extra).save())
        execute(upsert_statement(table, staging, list(keys), rows.columns))

    with_retries(once, attempts)
