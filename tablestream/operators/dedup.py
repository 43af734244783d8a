"""Deduplication and top-N.

All of them filter on ``row_number() <= n``: Spark then limits each group *before* the shuffle
(WindowGroupLimit), so a hot key sends n rows per map task, not all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .core import Keys, as_list


def _order(order_by: Sequence[str | Column] | str | Column, desc: bool) -> list[Column]:
    cols = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not cols:
        raise ValueError("an order is needed: without one the kept row is arbitrary")
    return [(F.col(c).desc() if desc else F.col(c).asc()) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, keys: Keys, order_by, n: int, desc: bool = True, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group in the given order; ``rank`` keeps the place as a column."""
    name = rank or "__rn"
    w = Window.partitionBy(*as_list(keys)).orderBy(*_order(order_by, desc))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def dedup_last(df: DataFrame, keys: Keys, order_by) -> DataFrame:
    return top_n(df, keys, order_by, 1, desc=True)


def dedup_first(df: DataFrame, keys: Keys, order_by) -> DataFrame:
    return top_n(df, keys, order_by, 1, desc=False)


def dedup_content(df: DataFrame, cols: Keys, order_by) -> DataFrame:
    """Latest row per content. Long contents travel as their SHA-256, not as the text."""
    h = F.sha2(F.to_json(F.struct(*as_list(cols))), 256)
    return dedup_last(df.withColumn("__content", h), "__content", order_by).drop("__content")


def dedup_two_level(df: DataFrame, inner: Keys, inner_order, outer: Keys, outer_order) -> DataFrame:
    """Keep the last row per inner key (e.g. transaction), then the last of these per outer key."""
    return dedup_last(dedup_last(df, inner, inner_order), outer, outer_order)


def first_per_value(df: DataFrame, keys: Keys, col: str, order_by) -> DataFrame:
    """First row of each (key, value): a value that comes back later is not reported again."""
    return dedup_first(df, [*as_list(keys), col], order_by)


def dedup_priority(df: DataFrame, keys: Keys, priority: Column, order_by) -> DataFrame:
    """Lowest priority number wins, then the newest row."""
    order = [priority.asc(), *_order(order_by, True)]
    return top_n(df, keys, order, 1)


def order_limit(df: DataFrame, order_by, n: int, desc: bool = True) -> DataFrame:
    return df.orderBy(*_order(order_by, desc)).limit(n)


def dedup_after(fan_out: dict[str, DataFrame], keys: Keys, order_by) -> dict[str, DataFrame]:
    """Dedup once more on the key of each sink after a fan-out."""
    return {name: dedup_last(d, keys, order_by) for name, d in fan_out.items()}


def latest_then_collect(df: DataFrame, row_keys: Keys, order_by, group: Keys, fields: Keys,
                        name: str = "items") -> DataFrame:
    """Latest version of each row, then one sorted array of rows per group."""
    from .aggs import collect_rows
    return collect_rows(dedup_last(df, row_keys, order_by), group, fields, name)
