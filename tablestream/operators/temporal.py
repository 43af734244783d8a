"""Joins on time: as-of, interval, range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .core import Keys, as_list, epoch_us, interval, seconds
from .sequence import attach, carry_over, chunk_window, grid_for, next_known, on_grid, with_chunk


def join_asof(l: DataFrame, r: DataFrame, on: Keys, lts: str, rts: str, how: str = "left", ttl: str | None = None,
              base: DataFrame | None = None) -> DataFrame:
    """For each left row the latest right row of its key with ``rts <= lts``.

    Both sides are laid on one time line per key and the latest right row is carried forward: linear in
    the input, one shuffle, no pairs, and a hot key is cut in time (see ``sequence``). A version valid
    exactly at the left time counts; of versions with equal time the largest by column order is taken.
    ``ttl`` drops versions older than that. ``base``: frame to count the left keys on, if ``l`` is costly.
    """
    k = as_list(on)
    vals = [c for c in r.columns if c not in k]
    if set(vals) & set(l.columns):
        raise ValueError(f"rename {sorted(set(vals) & set(l.columns))}: both sides have them")
    right = r.filter(F.col(rts).isNotNull()).select(*k, F.col(rts).alias("__t"), F.lit(0).alias("__side"),
                                                    F.struct(*vals).alias("__r"))
    left = l.select(*k, F.col(lts).alias("__t"), F.lit(1).alias("__side"), F.struct(*l.columns).alias("__l"))
    counted = (base if base is not None else l).select(*k, F.col(lts).alias("__t")).unionByName(right.select(*k, "__t"))
    grid = grid_for(counted, k, "__t")
    newest = F.max_by("__r", F.struct("__t", "__r"))
    carry = carry_over(on_grid(right, k, "__t", grid), k, {"__m": newest}, {"__before": ("last", "__m")}, grid=grid)
    line = on_grid(left.unionByName(right, allowMissingColumns=True), k, "__t", grid)
    w = chunk_window(k, ["__t", "__side", "__r"]).rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumn("__here", F.last("__r", ignorenulls=True).over(w)).filter("__side = 1")
    got = attach(line, carry, k).withColumn("__v", F.coalesce("__here", "__before"))
    valid = F.col("__t").isNotNull()
    for c in k:                                  # SQL equality: a NULL key has no match
        valid = valid & F.col(c).isNotNull()
    if ttl:
        got = got.withColumn("__rt", F.col(f"__v.{rts}"))
        gap = epoch_us(got, "__t") - epoch_us(got, "__rt")
        valid = valid & (gap <= round(seconds(ttl) * 1_000_000))
    got = got.withColumn("__v", F.when(valid, F.col("__v")))
    if how == "inner":
        got = got.filter("__v is not null")
    return got.select("__l.*", *[F.col(f"__v.{c}").alias(c) for c in vals])


def versions(df: DataFrame, keys: Keys, ts: str) -> DataFrame:
    """Validity intervals of versions: [valid_from, valid_to), open end = NULL."""
    k = as_list(keys)
    d = with_chunk(df, k, ts)
    carry = carry_over(d, k, {"__m": F.min(ts)}, {"__next": ("last", "__m")}, backwards=True)
    local = d.withColumn("__lead", F.lead(ts).over(chunk_window(k, [ts])))
    return attach(local, carry, k).select(*df.columns, F.col(ts).alias("valid_from"), F.coalesce("__lead", "__next").alias("valid_to"))


def join_rules(events: DataFrame, rules: DataFrame, on: Keys, lts: str, rts: str, breach: Column, how: str = "inner") -> DataFrame:
    """Rule version valid at event time for a composite key, kept when the rule's thresholds are broken."""
    return join_asof(events, rules, on, lts, rts, how).filter(breach)


def enrich_asof_many(l: DataFrame, lts: str, dims: Sequence[tuple[DataFrame, Keys, str]]) -> DataFrame:
    out = l
    for dim, on, rts in dims:
        out = join_asof(out, dim, on, lts, rts, base=l)
    return out


def feature_join(labels: DataFrame, feats: DataFrame, keys: Keys, lts: str, rts: str, ttl: str) -> DataFrame:
    """Point-in-time features: the newest at or before the label, no older than ``ttl``."""
    return join_asof(labels, feats, keys, lts, rts, "left", ttl)


def _time_buckets(df: DataFrame, ts: str, size_us: int, lo_us: int = 0, hi_us: int = 0, name: str = "__b") -> DataFrame:
    us = epoch_us(df, ts)
    first, last = F.floor((us + lo_us) / size_us), F.floor((us + hi_us) / size_us)
    if lo_us == hi_us:
        return df.withColumn(name, first.cast("long"))
    return df.withColumn(name, F.explode(F.sequence(first.cast("long"), last.cast("long"))))


def join_interval(l: DataFrame, r: DataFrame, on: Keys, lts: str, rts: str, lo: str | float, hi: str | float,
                  how: str = "inner") -> DataFrame:
    """Pairs of equal key with ``lts + lo <= rts <= lts + hi`` (``lo`` may be negative: '-10 minutes').

    Time buckets as wide as the interval join the key in the hash, so a row meets only rows of about its
    own time, not its key's whole history. Without key columns this is a range join (``on=[]``).
    """
    k = as_list(on)
    lo_us, hi_us = (round(_signed(x) * 1_000_000) for x in (lo, hi))
    if hi_us < lo_us:
        raise ValueError("empty interval")
    size = max(hi_us - lo_us, 1_000_000)
    if set(r.columns) & (set(l.columns) - set(k)):
        raise ValueError("rename columns both sides have")
    lb = _time_buckets(l, lts, size, lo_us, hi_us).withColumn("__lus", epoch_us(l, lts))
    rb = _time_buckets(r, rts, size).withColumn("__rus", epoch_us(r, rts))
    gap = F.col("__rus") - F.col("__lus")
    hit = lb.join(rb, [*k, "__b"]).filter((gap >= lo_us) & (gap <= hi_us)).drop("__b", "__lus", "__rus")
    if how == "inner":
        return hit.select(*l.columns, *[c for c in r.columns if c not in k])
    if how == "left_anti":
        return _unmatched(l, r, k, lts, rts, lo_us, hi_us)
    if how != "left":
        raise ValueError("inner, left or left_anti")
    none = _unmatched(l, r, k, lts, rts, lo_us, hi_us)
    pad = none.select(*l.columns, *[F.lit(None).cast(r.schema[c].dataType).alias(c) for c in r.columns if c not in k])
    return hit.select(*l.columns, *[c for c in r.columns if c not in k]).unionByName(pad)


def _signed(x: str | float) -> float:
    if isinstance(x, str) and x.strip().startswith("-"):
        return -seconds(x.strip()[1:])
    return seconds(x) if isinstance(x, str) and x.strip() != "0" else float(x)


def _unmatched(l: DataFrame, r: DataFrame, k: Sequence[str], lts: str, rts: str, lo_us: int, hi_us: int) -> DataFrame:
    """Left rows without partner. Per (key, bucket) only the sorted distinct times matter, so this is a
    nearest-neighbour test on a time line: the first right time >= lts + lo must be > lts + hi."""
    us_l, us_r = epoch_us(l, lts), epoch_us(r, rts)
    left = l.withColumn("__t", us_l + lo_us)
    line_l = left.select(*k, F.col("__t"), F.lit(0).alias("__side"), F.struct(*l.columns).alias("__l"),
                         F.lit(None).cast("long").alias("__rt"))
    line_r = (r.select(*k, us_r.alias("__t")).distinct()
              .select(*k, "__t", F.lit(1).alias("__side"), F.lit(None).cast(line_l.schema["__l"].dataType).alias("__l"),
                      F.col("__t").alias("__rt")))
    nxt = next_known(line_l.unionByName(line_r), k, ["__t", "__side"], "__rt", "__next")
    miss = F.col("__next").isNull() | (F.col("__next") > F.col("__t") + (hi_us - lo_us)) | F.col("__t").isNull()
    for c in k:
        miss = miss | F.col(c).isNull()
    return nxt.filter((F.col("__side") == 0) & miss).select("__l.*")


def join_range(l: DataFrame, r: DataFrame, lts: str, rts: str, lo: str | float, hi: str | float) -> DataFrame:
    """Time-range join without key: the time bucket is the hash key."""
    return join_interval(l, r, [], lts, rts, lo, hi)


def join_ttl(l: DataFrame, r: DataFrame, on: Keys, lts: str, rts: str, l_ttl: str, r_ttl: str, how: str = "inner") -> DataFrame:
    """Join whose sides are remembered for a limited time: a left row meets right rows that arrive within
    ``l_ttl`` after it or arrived at most ``r_ttl`` before it."""
    return join_interval(l, r, on, lts, rts, f"-{r_ttl}", l_ttl, how)


def lead_time(a: str, b: str, unit: str = "HOUR") -> Column:
    """Whole units from ``a`` to ``b``."""
    return F.timestamp_diff(unit, F.col(a), F.col(b))


def missing_followup(df: DataFrame, keys: Keys, ts: str, is_open: Column, is_close: Column, timeout: str,
                     as_of: str | None = None) -> DataFrame:
    """Opening events without a closing event of the same key within ``timeout`` after them."""
    k = as_list(keys)
    opened = df.filter(is_open)
    closed = df.filter(is_close).select(*k, F.col(ts).alias("__close_ts"))
    out = join_interval(opened, closed, k, ts, "__close_ts", 0, timeout, "left_anti")
    if as_of is not None:                         # not yet due: no verdict
        out = out.filter(F.col(ts) + interval(seconds(timeout)) <= F.lit(as_of).cast(df.schema[ts].dataType))
    return out
