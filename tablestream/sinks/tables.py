"""Append, upsert, retract and partition sinks on plain files.

The upsert sink is an append-only log of deduplicated batches: each batch is one ``_batch=<id>`` folder,
written with overwrite, so writing it again after a failure changes nothing. A read takes the last row per
key. A batch costs what the batch holds, never a rewrite of the table; ``compact_upsert`` folds the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..operators.changelog import KIND, apply_changelog
from ..operators.core import Keys, as_list, join_null_safe
from ..operators.dedup import dedup_last
from ..session import scratch_dir

BATCH, DELETED, COMMITTED = "_batch", "_deleted", "_committed_at"


def write_append(df: DataFrame, target: str, partition_by: Keys = (), fmt: str = "parquet") -> None:
    df.write.mode("append").partitionBy(*as_list(partition_by)).format(fmt).save(target)


def write_csv(df: DataFrame, target: str, header: bool = True, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(target)


def write_text(df: DataFrame, target: str, line: Column) -> None:
    df.select(line.cast("string").alias("value")).write.mode("overwrite").text(target)


def write_console(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)


def write_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def write_bucketed(df: DataFrame, table: str, keys: Keys, n: int, sort: bool = True, path: str | None = None) -> None:
    """Catalog table hashed into ``n`` buckets; later joins and aggregates on the keys need no shuffle."""
    k = as_list(keys)
    w = df.repartition(n, *k).write.mode("overwrite").format("parquet").bucketBy(n, *k)
    w = w.option("path", path) if path else w
    (w.sortBy(*k) if sort else w).saveAsTable(table)


def refresh_partition(df: DataFrame, target: str, partition_by: Keys) -> None:
    """Overwrite only the partitions that occur in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*as_list(partition_by)).parquet(target))


# ---- upsert ----------------------------------------------------------------------------------------

def last_batch(spark: SparkSession, target: str, column: str = BATCH) -> int | None:
    """Highest batch number of a log (from the folder names)."""
    try:
        row = spark.read.parquet(target).agg(F.max(column)).first()
    except AnalysisException:
        return None
    return row[0] if row else None


def write_upsert(df: DataFrame, target: str, keys: Keys, order_by: Keys, batch_id: int | None = None, delete_when: Column | None = None,
                 committed_at: str | None = None) -> int:
    """Upsert by key, last write wins; rows with ``delete_when`` are tombstones. Returns the batch number."""
    n = batch_id if batch_id is not None else (last_batch(df.sparkSession, target) or 0) + 1
    gone = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    at = F.lit(committed_at).cast("timestamp") if committed_at else F.current_timestamp()
    rows = dedup_last(df, keys, as_list(order_by)).withColumn(DELETED, gone).withColumn(COMMITTED, at)
    rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={n}")
    return n


def read_upsert(spark: SparkSession, target: str, keys: Keys, order_by: Keys, upto: int | None = None, as_of: str | None = None) -> DataFrame:
    """Current rows of an upsert target; ``upto`` / ``as_of`` read an earlier state (time travel)."""
    log = spark.read.option("mergeSchema", True).parquet(target)
    if upto is not None:
        log = log.filter(F.col(BATCH) <= upto)
    if as_of is not None:
        log = log.filter(F.col(COMMITTED) <= F.lit(as_of).cast("timestamp"))
    last = dedup_last(log, keys, [*as_list(order_by), BATCH])
    return last.filter(~F.col(DELETED)).drop(BATCH, DELETED, COMMITTED)


def read_as_of(spark: SparkSession, target: str, keys: Keys, order_by: Keys, t: str) -> DataFrame:
    return read_upsert(spark, target, keys, order_by, as_of=t)


def compact_upsert(spark: SparkSession, target: str, into: str, keys: Keys, order_by: Keys) -> int:
    """Fold a log into one batch of a new target (tombstones included, so late older rows stay beaten)."""
    n = last_batch(spark, target) or 0
    last = dedup_last(spark.read.option("mergeSchema", True).parquet(target), keys, [*as_list(order_by), BATCH])
    last.drop(BATCH).write.mode("overwrite").parquet(f"{into}/{BATCH}={n}")
    return n


# ---- retract ---------------------------------------------------------------------------------------

def write_retract(df: DataFrame, target: str, keys: Keys, order_by: Keys, batch_id: int | None = None) -> int:
    """Write the change of each key as -U old / +U new, or +I when it is new; unchanged rows write nothing."""
    spark, k = df.sparkSession, as_list(keys)
    n = batch_id if batch_id is not None else (last_batch(spark, target) or 0) + 1
    payload = [c for c in df.columns if c not in k]
    new = dedup_last(df, k, as_list(order_by)).select(*k, F.struct(*payload).alias("__new"))
    if last_batch(spark, target) is None:
        j = new.withColumn("__old", F.lit(None).cast(new.schema["__new"].dataType))
    else:
        old = read_retract(spark, target, k, before=n).select(*k, F.struct(*payload).alias("__old"))
        j = join_null_safe(new, old, k, "left")
    entry = lambda kind, c, seq: F.struct(F.lit(kind).alias(KIND), F.lit(seq).alias("_seq"), F.col(c).alias("r"))
    out = (F.when(F.col("__old").isNull(), F.array(entry("+I", "__new", 0)))
           .when(~F.col("__old").eqNullSafe(F.col("__new")), F.array(entry("-U", "__old", 0), entry("+U", "__new", 1))))
    rows = j.select(*k, F.explode(out).alias("x")).select(F.col(f"x.{KIND}").alias(KIND), "x._seq", *k, "x.r.*")
    rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={n}")
    return n


def read_retract(spark: SparkSession, target: str, keys: Keys, before: int | None = None) -> DataFrame:
    """Table a retract log stands for."""
    log = spark.read.parquet(target)
    if before is not None:
        log = log.filter(F.col(BATCH) < before)
    return apply_changelog(log, keys, [BATCH, "_seq"]).drop(BATCH, "_seq")


# ---- several sinks, refresh ------------------------------------------------------------------------

def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> None:
    """One read, many sinks: the input is computed once, written to the shared folder, and every sink reads it there."""
    path = scratch_dir(df.sparkSession, "fan-out")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    for write in sinks.values():
        write(kept)


def fan_out_stream(sinks: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that gives every sink the same micro-batch."""
    def each(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, {n: (lambda b, w=w: w(b, batch_id)) for n, w in sinks.items()})
    return each


def incremental_append(src: DataFrame, target: str, ts: str) -> DataFrame:
    """Append only rows newer than the target's newest; the bound reaches the source scan as a filter."""
    try:
        high = src.sparkSession.read.parquet(target).agg(F.max(ts)).first()[0]
    except AnalysisException:
        high = None
    new = src if high is None else src.filter(F.col(ts) > F.lit(high).cast(src.schema[ts].dataType))
    write_append(new, target)
    return new


def materialize_full(fn: Callable[[], DataFrame], target: str, version: int | None = None) -> int:
    """Full refresh: a new complete version beside the old one. A version counts once it is noted in ``_committed``, which is written
    after it: a refresh that breaks off leaves readers where they were, and the next one writes over what it left."""
    df = fn()
    n = version if version is not None else (last_committed(df.sparkSession, target) or 0) + 1
    df.write.mode("overwrite").parquet(f"{target}/_version={n}")
    df.sparkSession.range(1).select(F.lit(n).cast("long").alias("version")).write.mode("append").parquet(f"{target}/_committed")
    return n


def last_committed(spark: SparkSession, target: str) -> int | None:
    """Newest complete version of a materialized table."""
    try:
        return spark.read.parquet(f"{target}/_committed").agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def read_materialized(spark: SparkSession, target: str) -> DataFrame:
    n = last_committed(spark, target)
    if n is None:
        raise ValueError(f"{target} holds no version yet")
    return spark.read.parquet(f"{target}/_version={n}")


def materialize_stream(stream: DataFrame, target: str, checkpoint: str, keys: Keys, order_by: Keys, freshness: str | None = None):
    """Continuous refresh: each micro-batch is upserted. ``freshness`` is the trigger interval; without one the
    backlog is processed and the query ends, to go on from its checkpoint when started again."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: write_upsert(b, target, keys, order_by, i) and None))
    return (w.trigger(processingTime=freshness) if freshness else w.trigger(availableNow=True)).start()


def layers(spark: SparkSession, folder: str, steps: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]]) -> Callable[[str], DataFrame]:
    """Raw -> source -> intermediate -> fact tables: each step reads earlier tables and is written before the next."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    for name, build in steps.items():
        build(read).write.mode("overwrite").parquet(f"{folder}/{name}")
    return read
