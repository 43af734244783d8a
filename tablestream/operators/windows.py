"""Time windows over rows: tumble, hop, cumulate, session, count windows and their combinations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import gcd

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .core import (Aggs, Keys, all_of, as_list, epoch_us, finish_aggs, interval, join_null_safe, merge_aggs, partial_aggs,
                   partial_names, seconds)
from .batches import group_slices
from .sequence import CHUNK, HOT, chunk_window, with_chunk

BOUNDS = ("window_start", "window_end")


def _bounds(w: str = "w") -> list[Column]:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def tumble(df: DataFrame, ts: str, size: str, keys: Keys | None, aggs: Aggs) -> DataFrame:
    """Fixed windows aligned to 1970-01-01. Works on a stream too (set the watermark first)."""
    k = as_list(keys)
    g = df.groupBy(F.window(ts, size).alias("w"), *k).agg(*partial_aggs(aggs))
    return g.select(*_bounds(), *k, *finish_aggs(aggs))


def hop(df: DataFrame, ts: str, slide: str, size: str, keys: Keys | None, aggs: Aggs, panes: bool | None = None) -> DataFrame:
    """Overlapping windows. With many windows per row the rows are first summed into panes (gcd of slide and
    size), and only panes are copied into the windows that cover them."""
    k = as_list(keys)
    s, z = round(seconds(slide) * 1000), round(seconds(size) * 1000)
    if panes is None:
        panes = z // s > 4
    if not panes or df.isStreaming:
        g = df.groupBy(F.window(ts, size, slide).alias("w"), *k).agg(*partial_aggs(aggs))
        return g.select(*_bounds(), *k, *finish_aggs(aggs))
    pane = f"{gcd(s, z)} milliseconds"
    p = df.groupBy(F.window(ts, pane).alias("p"), *k).agg(*partial_aggs(aggs)).withColumn("__p", F.col("p.start"))
    x = spread(p, "__p", slide, s / 1000, z / 1000, k)
    g = x.groupBy("__blk", "window_start", *k).agg(*merge_aggs(aggs))
    return g.select("window_start", (F.col("window_start") + interval(z / 1000)).alias("window_end"), *k, *finish_aggs(aggs))


def spread(panes: DataFrame, at: str, slide: str, slide_s: float, size_s: float, keys: list[str]) -> DataFrame:
    """Copy each pane into the windows over it.

    Windows are grouped into blocks of eight sizes. A pane goes to the one or two blocks its windows lie in
    and is hashed by (key, block); its copies are made there. So about one row per pane is shuffled, not
    one per window, and a key with a long history is spread. Group by ``__blk`` too: it follows from the start.
    """
    back = round(-(-size_s // slide_s) - 1)
    block_s = 8 * (back + 1) * slide_s                            # a multiple of the slide, so blocks hold whole windows
    start_of = lambda d, col, size, name: d.select("*", F.window(col, size).alias("__w")).withColumn(name, F.col("__w.start")).drop("__w")
    d = start_of(panes, at, slide, "__last").withColumn("__first", F.col("__last") - interval(back * slide_s))
    d = start_of(start_of(d, "__first", f"{block_s} seconds", "__b0"), "__last", f"{block_s} seconds", "__b1")
    d = d.withColumn("__blk", F.explode(F.array_distinct(F.array("__b0", "__b1")))).drop("__b0", "__b1")
    starts = F.sequence(F.greatest("__first", "__blk"), F.least("__last", F.col("__blk") + interval(block_s - slide_s)), interval(slide_s))
    x = d.repartition(*keys, "__blk").withColumn("window_start", F.explode(starts)).drop("__first", "__last")
    return x if size_s % slide_s == 0 else x.filter(F.col("window_start") + interval(size_s) > F.col(at))


def cumulate(df: DataFrame, ts: str, step: str, size: str, keys: Keys | None, aggs: Aggs) -> DataFrame:
    """Windows that grow by ``step`` up to ``size``, then start again."""
    k = as_list(keys)
    st, z = seconds(step), seconds(size)
    if z % st:
        raise ValueError("size must be a multiple of step")
    p = (df.groupBy(F.window(ts, step).alias("p"), *k).agg(*partial_aggs(aggs))
         .select("*", F.col("p.start").alias("__p"), F.col("p.end").alias("__pe")))
    p = p.select("*", F.window("__p", size).alias("w")).select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("__end"))
    ends = F.sequence(F.col("__pe"), F.col("__end"), interval(st))
    x = p.repartition("window_start", *k).withColumn("window_end", F.explode(ends))        # copies of a window meet here
    g = x.groupBy("window_start", "window_end", *k).agg(*merge_aggs(aggs))
    return g.select(*BOUNDS, *k, *finish_aggs(aggs))


def session(df: DataFrame, ts: str, gap: str, keys: Keys, aggs: Aggs) -> DataFrame:
    """Sessions per key: a pause longer than ``gap`` starts a new one; window_end = last event + gap.

    Sessions are numbered inside (key, chunk) and aggregated there. Only hot keys have more than one chunk;
    of these only a chunk's first and last session can continue across its border, and only those are
    ordered per key and merged.
    """
    k = as_list(keys)
    if df.isStreaming:
        g = df.groupBy(F.session_window(ts, gap).alias("w"), *k).agg(*partial_aggs(aggs))
        return g.select(*_bounds(), *k, *finish_aggs(aggs))
    names, gap_us = partial_names(aggs), round(seconds(gap) * 1_000_000)
    started = lambda first, before: F.when(first - before > gap_us, 1).otherwise(0)
    d = with_chunk(df.filter(F.col(ts).isNotNull()), k, ts).withColumn("__us", epoch_us(df, ts))
    w = chunk_window(k, ["__us"])
    d = (d.select("*", started(F.col("__us"), F.lag("__us").over(w)).alias("__new"), F.lead("__us").over(w).isNull().alias("__end"))
         .withColumn("__lsid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    loc = (d.groupBy(*k, CHUNK, "__lsid")
           .agg(F.any_value(HOT).alias(HOT), F.max("__end").alias("__end"), F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.min("__us").alias("__fus"),
                F.max("__us").alias("__lus"), *partial_aggs(aggs)))
    loc = loc.withColumn("__edge", F.coalesce(F.col(HOT) & ((F.col("__lsid") == 0) | F.col("__end")), F.lit(False)))
    inner = loc.filter(~F.col("__edge")).select(*k, "__first", "__last", *names)
    w = Window.partitionBy(*k).orderBy("__fus")
    merged = (loc.filter("__edge").withColumn("__new", started(F.col("__fus"), F.lag("__lus").over(w)))
              .withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*k, "__sid").agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"), *merge_aggs(aggs))
              .select(*k, "__first", "__last", *names))
    return (inner.unionByName(merged)
            .select(F.col("__first").alias("window_start"),
                    (F.col("__last") + interval(seconds(gap))).alias("window_end"), *k, *finish_aggs(aggs)))


def session_collect(df: DataFrame, ts: str, gap: str, keys: Keys, col: str, order: Keys = (), part_rows: int = 10_000,
                    name: str = "items") -> DataFrame:
    """Sessions with the ordered list of values, start, end and length in seconds.

    Each row finds its session by an as-of join on session starts. A list longer than ``part_rows`` goes on
    in the next ``part``, so one endless session does not end up in one row.
    """
    from .aggs import collect_parts
    from .temporal import join_asof
    k, o = as_list(keys), as_list(order)
    s = cut_lineage(session(df, ts, gap, k, {"n": ("count", "*"), "last_ts": ("max", ts)}))
    rows = join_asof(df.select(*k, ts, *o, col), s.select(*k, F.col("window_start").alias("session_start"), "last_ts"),
                     k, ts, "session_start", "inner")
    c = collect_parts(rows, [*k, "session_start", "last_ts"], [ts, *o], col, part_rows, name)
    return (c.withColumn(name, F.transform(name, lambda x: x[col]))
            .withColumn("session_seconds", F.timestamp_diff("SECOND", "session_start", "last_ts")))


def rolling_features(df: DataFrame, ts: str, keys: Keys, value: str, bucket: str = "1 hour", long_hours: int = 12,
                     short_hours: int = 6, round_to: int | None = None) -> DataFrame:
    """Hourly buckets, then a window of ``long_hours`` that slides by one bucket, with a nested shorter horizon.

    The short horizon takes buckets with ``bucket_end >= window_end - short``.
    """
    k = as_list(keys)
    b = tumble(df, ts, bucket, k, {"cnt": ("count", "*"), "amt_sum": ("sum", value)})
    if round_to is not None:
        b = b.withColumn("amt_sum", F.round("amt_sum", round_to))
    b = b.withColumnsRenamed({"window_start": "bucket_start", "window_end": "bucket_end"})
    long_s = long_hours * 3600
    x = spread(b, "bucket_start", bucket, seconds(bucket), long_s, k).withColumn("feature_time", F.col("window_start") + interval(long_s))
    recent = F.col("bucket_end") >= F.col("feature_time") - interval(short_hours * 3600)
    s, l = f"{short_hours}h", f"{long_hours}h"
    return (x.groupBy(*k, "__blk", "window_start").agg(
                F.min("feature_time").alias("feature_time"),
                F.sum(F.when(recent, F.col("cnt"))).alias(f"cnt_{s}"), F.sum("cnt").alias(f"cnt_{l}"),
                F.sum(F.when(recent, F.col("amt_sum"))).alias(f"amt_sum_{s}"), F.sum("amt_sum").alias(f"amt_sum_{l}"))
            .select(*k, "feature_time", f"cnt_{s}", f"cnt_{l}", f"amt_sum_{s}", f"amt_sum_{l}"))


def tumble_distinct(df: DataFrame, ts: str, size: str, keys: Keys | None, cols: Keys, name: str = "n") -> DataFrame:
    """COUNT DISTINCT per window: distinct (window, key, id) first, then a plain count; ids with a NULL part do not count."""
    k, c = as_list(keys), as_list(cols)
    d = df.select(F.window(ts, size).alias("w"), *k, *[x for x in c if x not in k]).distinct()
    return d.groupBy("w", *k).agg(F.count_if(all_of([F.col(x).isNotNull() for x in c])).alias(name)).select(*_bounds(), *k, name)


def tumble_collect_rows(df: DataFrame, ts: str, size: str, keys: Keys, fields: Keys, order: Keys = (), part_rows: int = 10_000,
                        name: str = "items") -> DataFrame:
    """Rows of each (window, key) as arrays in time order, a full array going on in the next ``part``."""
    from .aggs import collect_parts
    d = df.filter(F.col(ts).isNotNull()).select("*", F.window(ts, size).alias("w")).select(*_bounds(), *df.columns)
    return collect_parts(d, [*BOUNDS, *as_list(keys)], [ts, *as_list(order)], fields, part_rows, name)


def tumble_max(df: DataFrame, ts: str, size: str, keys: Keys | None, by: Keys) -> DataFrame:
    """The record with the largest ``by`` in each window (a top-1 that is cut before the shuffle)."""
    from .dedup import dedup_last
    k = as_list(keys)
    d = df.select("*", F.window(ts, size).alias("w")).select(*_bounds(), *df.columns)
    return dedup_last(d, ["window_start", "window_end", *k], as_list(by))


def batch_messages(df: DataFrame, ts: str, key: Column, payload: str, buckets: int, order: Keys,
                   size: str = "1 second", keep: Column | None = None, max_rows: int = 10_000, sep: str = "\n") -> DataFrame:
    """Messages of one (window, bucket) joined into one payload, deletes filtered out.

    A payload holds at most ``max_rows`` messages; a fuller window gives further parts, so nothing is dropped
    and no payload outgrows a task. ``key`` must be an integer expression; the bucket is ``pmod(key, buckets)``.
    """
    from .sequence import position
    o = as_list(order)
    d = df.filter(keep) if keep is not None else df
    d = d.select(ts, F.window(ts, size).alias("w"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"),
                 F.struct(*[F.col(x) for x in [ts, *o]]).alias("o"), F.col(payload).alias("v")).filter("v is not null")
    d = position(d, ["w", "bucket"], [ts, "o"], "place")
    d = d.withColumn("part", F.floor((F.col("place") - 1) / max_rows).cast("int"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("o", "v"))), lambda x: x["v"])
    g = d.groupBy("w", "bucket", "part").agg(F.array_join(lines, sep).alias("val"), F.count(F.lit(1)).alias("n"))
    return g.select(*_bounds(), F.concat(F.lit("b"), F.col("bucket").cast("string")).alias("key"), "part", "n", "val")


def count_window(df: DataFrame, keys: Keys, order: Keys, n: int, aggs: Aggs, full_only: bool = True) -> DataFrame:
    """Groups of ``n`` consecutive rows per key; only full groups fire unless ``full_only`` is off."""
    from .over import row_number
    k = as_list(keys)
    d = row_number(df, k, order, "__pos").withColumn("window_no", F.floor((F.col("__pos") - 1) / n).cast("long"))
    g = d.groupBy(*k, "window_no").agg(F.count(F.lit(1)).alias("__rows"), *partial_aggs(aggs))
    if full_only:
        g = g.filter(F.col("__rows") == n)
    return g.select(*k, "window_no", *finish_aggs(aggs))


def apply_window(df: DataFrame, ts: str, size: str, keys: Keys, fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[tuple]],
                 schema: str) -> DataFrame:
    """Call ``fn(key, parts)`` for each (window, key), with ``key`` = (window_start, window_end, *keys).

    For logic no aggregate can express. ``parts`` are pandas frames in time order, ``fn`` yields result rows
    as tuples. Rows stream in batches, so a big window needs no big memory as long as ``fn`` keeps a running
    state instead of the rows.
    """
    g = [*BOUNDS, *as_list(keys)]
    d = df.select("*", F.window(ts, size).alias("w")).select(*_bounds(), *df.columns)
    names = T._parse_datatype_string(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices, out = group_slices(batches, g), []
        held = next(slices, None)
        while held is not None:
            key, after = held[0], []

            def parts() -> Iterator[pd.DataFrame]:
                yield held[1]
                for k, part, fresh in slices:
                    if fresh:
                        after.append((k, part, fresh))
                        return
                    yield part

            mine = parts()
            out += list(fn(key, mine))
            for _ in mine:                               # what ``fn`` left unread
                pass
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
            held = after[0] if after else None
        yield pd.DataFrame(out, columns=names)

    return d.repartition(*g).sortWithinPartitions(*g, ts).mapInPandas(run, schema)


def evict(df: DataFrame, ts: str, size: str, keys: Keys, last_n: int | None = None, last_t: str | None = None,
          tie: Keys = ()) -> DataFrame:
    """Rows left in each window after keeping its last ``n`` rows and / or its last ``t`` of time."""
    from .dedup import dedup_last, top_n
    k = as_list(keys)
    d = df.select("*", F.window(ts, size).alias("w")).select(*_bounds(), *df.columns)
    g = ["window_start", "window_end", *k]
    if last_t is not None:
        newest = d.groupBy(*g).agg(F.max(ts).alias("__newest"))
        d = join_null_safe(d, newest, g).filter(F.col(ts) >= F.col("__newest") - interval(seconds(last_t))).drop("__newest")
    return top_n(d, g, [ts, *as_list(tie)], last_n) if last_n is not None else d


def tumble_last_record(df: DataFrame, ts: str, size: str, keys: Keys, fields: Keys) -> DataFrame:
    """Row count and, per field, its latest non-null value in the window."""
    k = as_list(keys)
    last = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col(ts))).alias(f"last_{f}") for f in as_list(fields)]
    g = df.groupBy(F.window(ts, size).alias("w"), *k).agg(F.count(F.lit(1)).alias("n"), *last)
    return g.select(*_bounds(), *k, "n", *[f"last_{f}" for f in as_list(fields)])


def window_max_of_sums(df: DataFrame, ts: str, size: str, key: str, value: str) -> DataFrame:
    """Sum per (window, key), then the key with the largest sum in each window (ties: smallest key)."""
    s = tumble(df, ts, size, key, {"total": ("sum", value)})
    from .dedup import top_n
    return top_n(s.withColumn("total", F.round("total", 2)), list(BOUNDS), [F.col("total").desc(), F.col(key).asc()], 1)


def session_drop_alert(df: DataFrame, ts: str, gap: str, keys: Keys, short: str = "5 minutes", long: str = "60 minutes",
                       ratio: float = 0.5) -> DataFrame:
    """Sessions that end when the short rolling mean of session length falls under ``ratio`` x the long one."""
    from .over import over_range
    k = as_list(keys)
    s = session(df, ts, gap, k, {"n": ("count", "*"), "last_ts": ("max", ts)})
    s = cut_lineage(s.withColumn("session_seconds", F.timestamp_diff("SECOND", "window_start", "last_ts")))
    a = over_range(s, k, "window_end", long, {"long_sum": ("sum", "session_seconds"), "long_n": ("count", "session_seconds")})
    b = over_range(a, k, "window_end", short, {"short_sum": ("sum", "session_seconds"), "short_n": ("count", "session_seconds")})
    b = b.withColumn("short_avg", F.col("short_sum") / F.col("short_n")).withColumn("long_avg", F.col("long_sum") / F.col("long_n"))
    return b.filter(F.col("short_avg") < F.col("long_avg") * ratio).select(*k, "window_end", "short_avg", "long_avg")


def time_filter(df: DataFrame, ts: str, as_of: str, newer_than: str | None = None, older_than: str | None = None) -> DataFrame:
    """Rows by age against an explicit as-of time; both bounds reach the scan as pushed filters."""
    at = F.lit(as_of).cast(df.schema[ts].dataType)
    if newer_than:
        df = df.filter(F.col(ts) >= at - interval(seconds(newer_than)))
    if older_than:
        df = df.filter(F.col(ts) <= at - interval(seconds(older_than)))
    return df


def add_heartbeat(df: DataFrame, beats: DataFrame, ts: str, flag: str = "is_heartbeat") -> DataFrame:
    """Union rows that only carry time, so that windows close when real rows pause. Drop them after the window."""
    real = df.withColumn(flag, F.lit(False))
    cols = [F.col(ts).cast(df.schema[ts].dataType).alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
            for f in df.schema.fields]
    return real.unionByName(beats.select(*cols, F.lit(True).alias(flag)))
