"""Projection, filter, classification, routing and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .core import Keys, all_of, any_of, as_list


def with_cols(df: DataFrame, add: dict[str, Column] | None = None, rename: dict[str, str] | None = None,
              drop: Keys = ()) -> DataFrame:
    return df.withColumns(add or {}).withColumnsRenamed(rename or {}).drop(*as_list(drop))


def with_consts(df: DataFrame, consts: dict[str, object]) -> DataFrame:
    """Constant columns, e.g. to join on a composite key whose other part is fixed."""
    return df.withColumns({n: F.lit(v) for n, v in consts.items()})


def like_any(col: str, patterns: Sequence[str]) -> Column:
    return any_of([F.col(col).like(p) for p in patterns])


def classify(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """CASE ladder: the first rule that holds gives the value."""
    c = None
    for cond, value in rules:
        c = F.when(cond, value) if c is None else c.when(cond, value)
    return c.otherwise(default)


def clean(df: DataFrame, upper_trim: Keys, status: str, allowed: Sequence[str]) -> DataFrame:
    out = df.filter(F.col(status).isin(*allowed))
    return out.withColumns({c: F.upper(F.trim(c)) for c in as_list(upper_trim)})


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def mask(col: str, pattern: str, replacement: str = "****") -> Column:
    return F.regexp_replace(col, pattern, replacement)


def in_bbox(lon: str, lat: str, west: float, east: float, south: float, north: float) -> Column:
    return F.col(lon).between(west, east) & F.col(lat).between(south, north)


def route(df: DataFrame, rules: dict[str, Column], rest: str | None = None) -> dict[str, DataFrame]:
    """One frame per predicate; ``rest`` takes rows no predicate accepts (NULL counts as no)."""
    out = {name: df.filter(cond) for name, cond in rules.items()}
    if rest:
        out[rest] = df.filter(all_of([~F.coalesce(c, F.lit(False)) for c in rules.values()]))
    return out


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_rows(a: DataFrame, b: DataFrame, all_rows: bool = False) -> DataFrame:
    return a.exceptAll(b) if all_rows else a.subtract(b)


def count_compare(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per labelled frame with its row count."""
    return union_all([d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("label"), "n") for n, d in frames.items()])


def cutover(old: DataFrame, new: DataFrame, ts: str, at: Column) -> DataFrame:
    """Results of the old job up to ``at``, of the new job after it."""
    return old.filter(F.col(ts) <= at).unionByName(new.filter(F.col(ts) > at))


def normalize_out(df: DataFrame, key: str, cols: Keys, new_key: str) -> tuple[DataFrame, DataFrame]:
    """Move ``cols`` into their own table: (base with ``new_key``, side table). The key is a hash of the values."""
    c = as_list(cols)
    h = F.md5(F.to_json(F.struct(*c), {"ignoreNullFields": "false"}))
    d = df.withColumn(new_key, h)
    return d.drop(*c), d.select(new_key, *c).distinct()
