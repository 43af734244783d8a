"""Small helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

Keys = str | Sequence[str]
Aggs = dict[str, tuple[str, str]]

UNIT_SECONDS = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def as_list(x: Keys | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def seconds(interval: str | int | float) -> float:
    """'90 minutes' -> 5400. Calendar units (months, years) have no fixed length and are refused."""
    if isinstance(interval, (int, float)):
        return interval
    total = 0.0
    for n, unit in re.findall(r"([\d.]+)\s*([a-zA-Z]+)", interval):
        total += float(n) * UNIT_SECONDS[unit.lower().rstrip("s")]
    if total <= 0:
        raise ValueError(f"not an interval: {interval!r}")
    return total


def tasks_for(rows: int, rows_per_task: int = 250_000) -> int:
    """Partitions that hold a bounded number of rows each, whatever the size of the table."""
    return max(1, -(-rows // rows_per_task))


def interval(secs: float) -> Column:
    """A day-time interval literal of whole microseconds, safe for both timestamp types."""
    us = round(secs * 1_000_000)
    return F.expr(f"INTERVAL '{us // 1_000_000}.{us % 1_000_000:06d}' SECOND")


def epoch_us(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 as BIGINT. A zone-less timestamp is read as its wall clock."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC"):
            return F.unix_micros(c.cast("timestamp"))            # free, and no clock change can reorder it
        minutes = F.unix_date(c.cast("date")).cast("long") * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    if isinstance(df.schema[ts].dataType, T.DateType):
        return F.unix_date(c).cast("long") * 86_400_000_000
    return F.unix_micros(c)


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def hashable(df: DataFrame) -> list[str]:
    """Columns Spark can hash: not those that hold a MAP or a VARIANT."""
    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))
    return [f.name for f in df.schema.fields if ok(f.dataType)]


def any_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join that lets NULL keys meet (``<=>`` is hashable, so it stays a hash or merge join)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[F.col(c) for c in right.columns if c not in keys])
    cond = all_of([F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def drop_nulls_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(all_of([F.col(k).isNotNull() for k in keys]))


# ---- aggregates that can be computed in parts -------------------------------------------------
# name -> (function, column): functions count, count_if, sum, min, max, avg; column "*" for count.

def partial_aggs(aggs: Aggs) -> list[Column]:
    out: list[Column] = []
    for name, (fn, c) in aggs.items():
        src = F.lit(1) if c == "*" else F.expr(c)
        if fn == "count":
            out.append(F.count(src).alias(name))
        elif fn == "count_if":
            out.append(F.count_if(src).alias(name))
        elif fn == "avg":
            out += [F.sum(src.cast("double")).alias(f"{name}__s"), F.count(src).alias(f"{name}__n")]
        else:
            out.append({"sum": F.sum, "min": F.min, "max": F.max}[fn](src).alias(name))
    return out


def merge_aggs(aggs: Aggs) -> list[Column]:
    out: list[Column] = []
    for name, (fn, _) in aggs.items():
        if fn in ("count", "count_if", "sum"):
            out.append(F.sum(name).alias(name))
        elif fn == "avg":
            out += [F.sum(f"{name}__s").alias(f"{name}__s"), F.sum(f"{name}__n").alias(f"{name}__n")]
        else:
            out.append({"min": F.min, "max": F.max}[fn](name).alias(name))
    return out


def finish_aggs(aggs: Aggs) -> list[Column]:
    return [(F.col(f"{n}__s") / F.nullif(F.col(f"{n}__n"), F.lit(0))).alias(n) if fn == "avg" else F.col(n)
            for n, (fn, _) in aggs.items()]


def partial_names(aggs: Aggs) -> list[str]:
    return [p for n, (fn, _) in aggs.items() for p in ([f"{n}__s", f"{n}__n"] if fn == "avg" else [n])]
