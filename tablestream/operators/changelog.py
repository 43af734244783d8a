"""Changelogs with an explicit ``row_kind`` (+I, -U, +U, -D) and a sequence column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .aggs import agg
from .core import Aggs, Keys, as_list
from .dedup import dedup_last, dedup_priority
from .sequence import lag_in_order

KIND = "row_kind"


def apply_changelog(df: DataFrame, keys: Keys, seq: Keys, kind: str = KIND) -> DataFrame:
    """Table a changelog stands for: last row per key by sequence, deleted keys gone.

    -U rows only announce the +U after them and carry no state of their own.
    """
    live = df.filter(F.col(kind) != "-U")
    return dedup_last(live, keys, as_list(seq)).filter(F.col(kind) != "-D").drop(kind)


def to_retract(df: DataFrame, keys: Keys, order: Keys, cols: Keys | None = None) -> DataFrame:
    """Versions of a table -> retract stream: each change gives (-U old row, +U new row), the first +I."""
    k, o = as_list(keys), as_list(order)
    payload = as_list(cols) if cols is not None else [c for c in df.columns if c not in k]
    d = df.withColumn("__row", F.struct(*payload))
    d = lag_in_order(d, k, o, {"__old": "__row"})
    first = F.col("__old").isNull()
    out = F.when(first, F.array(F.struct(F.lit("+I").alias(KIND), F.col("__row").alias("r")))).otherwise(
        F.array(F.struct(F.lit("-U").alias(KIND), F.col("__old").alias("r")), F.struct(F.lit("+U").alias(KIND), F.col("__row").alias("r"))))
    x = d.select(*k, *[F.col(c).alias(f"__o_{c}") for c in o], F.explode(out).alias("x"))
    return x.select(F.col("x.row_kind").alias(KIND), *k, *[F.col(f"x.r.{c}").alias(c) for c in payload],
                    *[F.col(f"__o_{c}").alias(f"change_{c}") for c in o])


def normalize(df: DataFrame, keys: Keys, order: Keys, deleted: Column | None = None) -> DataFrame:
    """Upsert stream -> full changelog. Deletes become -D of the old row; a delete of an absent key gives nothing."""
    k, o = as_list(keys), as_list(order)
    payload = [c for c in df.columns if c not in k]
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    d = df.withColumn("__gone", gone).withColumn("__row", F.when(~F.col("__gone"), F.struct(*payload)))
    d = d.withColumn("__state", F.struct(F.col("__row").alias("r")))
    d = lag_in_order(d, k, o, {"__prev": "__state"}).withColumn("__old", F.col("__prev.r"))
    entry = lambda kind, row: F.struct(F.lit(kind).alias(KIND), F.col(row).alias("r"))
    has = F.col("__old").isNotNull()
    out = (F.when(F.col("__gone") & has, F.array(entry("-D", "__old")))
           .when(~F.col("__gone") & has, F.array(entry("-U", "__old"), entry("+U", "__row")))
           .when(~F.col("__gone"), F.array(entry("+I", "__row"))))
    x = d.select(*k, *[F.col(c).alias(f"__o_{c}") for c in o], F.explode(out).alias("x"))
    return x.select(F.col("x.row_kind").alias(KIND), *k, *[F.col(f"x.r.{c}").alias(c) for c in payload],
                    *[F.col(f"__o_{c}").alias(f"change_{c}") for c in o])


def retract_aggregate(log: DataFrame, keys: Keys, value: str, name: str = "total", kind: str = KIND) -> DataFrame:
    """Sum over a retract stream: -U and -D rows take their value back out."""
    sign = F.when(F.col(kind).isin("-U", "-D"), -1).otherwise(1)
    return log.groupBy(*as_list(keys)).agg(F.sum(F.col(value) * sign).alias(name), F.sum(sign).alias("n"))


def rehydrate(log: DataFrame, row_key: Keys, order: Keys, keys: Keys, aggs: Aggs) -> DataFrame:
    """State from a replayed log: each event counted once however often the log repeats it."""
    return agg(dedup_last(log, row_key, as_list(order)), keys, aggs)


def mix(hist: DataFrame, live: DataFrame, keys: Keys, ts: str, src: str = "src") -> DataFrame:
    """Historical snapshot and live log: a live row beats the snapshot of its key, then the newest wins."""
    u = hist.withColumn(src, F.lit("hist")).unionByName(live.withColumn(src, F.lit("live")))
    return dedup_priority(u, keys, F.when(F.col(src) == "live", 0).otherwise(1), [ts])


def changelog_chain(orders: DataFrame, order_key: Keys, order_by: Keys, products: DataFrame, product_key: Keys,
                    product_order: Keys) -> DataFrame:
    """Append log of orders -> current orders -> enriched with the current product."""
    current = dedup_last(orders, order_key, as_list(order_by))
    prod = dedup_last(products, product_key, as_list(product_order)).drop(*as_list(product_order))
    return current.join(prod, as_list(product_key), "left")
