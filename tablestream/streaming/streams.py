"""Streaming forms of the operators (Structured Streaming) and a way to run a stream to its end."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.core import Aggs, Keys, as_list, interval, seconds
from ..operators.sequence import CHUNK, attach, carry_over, with_chunk
from ..operators.windows import hop, session, tumble, tumble_last_record
from ..session import scratch_dir, tune
from ..sinks.tables import write_upsert

BEAT = "__beat"


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Bounded out-of-orderness. A zone-less time is read in the session zone first: watermarks need an instant."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def pick(df: DataFrame, cond: Column) -> DataFrame:
    """Filter that lets heartbeat rows through (it may be pushed below the watermark, where they are needed)."""
    return df.filter(F.coalesce(cond, F.lit(False)) | F.col(BEAT))


def without_beats(df: DataFrame, ts: str) -> DataFrame:
    """Drop heartbeat rows *after* they moved the watermark.

    The condition names the time column on purpose: a filter that does not is pushed below the watermark.
    """
    return df.filter(~F.col(BEAT) | F.col(ts).isNull()).drop(BEAT)


def run_stream(df: DataFrame, out: str, checkpoint: str, mode: str = "append", keys: Keys = (), order_by: Keys = ()) -> None:
    """Process the backlog and stop. Append streams write files; update streams upsert by key."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(lambda b, i: write_upsert(b.withColumn("_b", F.lit(i)), out, keys, order_by or "_b", i) and None).start()
    q.awaitTermination()


_slices: dict[tuple, str] = {}


def in_slices(spark: SparkSession, folder: str, table: str, ts: str, slices: int, late: Column | None = None, files: int = 1,
              at: tuple[str, ...] | None = None, only: Column | None = None) -> str:
    """The whole table as ``slices`` groups of ``files`` files in order of time (rows without time first), oldest modification first.

    Slices hold about equal numbers of rows, or begin at the times ``at`` (one less than slices). Rows for which ``late`` holds come one slice later than their time; ``only`` picks rows of the table. A copy is made once for each session and set of arguments.
    """
    key = (spark.sparkContext.applicationId, folder, table, ts, slices, str(late), files, at, str(only))
    if key not in _slices:
        df = spark.read.parquet(f"{folder}/{table}.parquet")
        df = df if only is None else df.where(only)
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        if at is not None:
            cuts = [F.unix_micros(F.lit(x).cast("timestamp")) for x in at]
        else:
            cuts = df.select(us.cast("double").alias("us")).approxQuantile("us", [i / slices for i in range(1, slices)], 0.001)
        nth = sum((F.when(us >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        if late is not None:
            nth = F.least(nth + F.when(late, 1).otherwise(0), F.lit(slices - 1))
        path = scratch_dir(spark, f"slices-{table}")
        for i in range(slices):                              # one job after the other: the stream takes files by age
            df.where(nth == i).repartition(files).write.mode("append").parquet(path)
        _slices[key] = path
    return _slices[key]


def replay(spark: SparkSession, folder: str, table: str, ts: str, delay: str, build: Callable[[DataFrame], DataFrame], mode: str = "append",
           keys: Keys = (), order_by: Keys = (), slices: int = 5, late: Column | None = None, files: int = 1, state_partitions: int = 12) -> DataFrame:
    """Run ``build`` over a table as a stream until everything is out, and return what it wrote.

    The table comes in ``slices`` micro-batches in order of time, so watermarks move, state is kept and dropped, and timers fire
    on the way. A second run from the same checkpoint brings one heartbeat row far in the future, so the watermark
    passes the last windows and timers. ``build`` gets the watermarked stream with a ``__beat`` column.
    ``state_partitions`` is the number of state stores and stays what it is for the life of a checkpoint: choose it by the state the
    stream will hold, not by today's input. The stream runs in a session of its own; the caller's settings are not touched.
    """
    own = tune(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    source = in_slices(spark, folder, table, ts, slices, late, files)
    root = scratch_dir(spark, f"replay-{table}")
    beats, out, chk = f"{root}/beats", f"{root}/out", f"{root}/checkpoint"
    spark.createDataFrame([], schema).write.mode("append").parquet(beats)

    def once() -> None:
        real = own.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source).withColumn(BEAT, F.lit(False))
        tick = own.readStream.schema(schema).parquet(beats).withColumn(BEAT, F.lit(True))
        run_stream(build(with_watermark(real.unionByName(tick), ts, delay)), out, chk, mode, keys, order_by)

    once()
    # the newest row moved on in time: a NULL key could be filtered out below the watermark
    newest = spark.read.parquet(f"{folder}/{table}.parquet").orderBy(F.col(ts).desc_nulls_last()).limit(1)
    newest.withColumn(ts, F.col(ts) + F.expr("INTERVAL 3650 DAYS")).write.mode("append").parquet(beats)
    once()
    return spark.read.parquet(out)


# ---- several sources -----------------------------------------------------------------------------------

def union_of_sources(spark: SparkSession, sources: Mapping[str, tuple[str, str]], schema: T.StructType, ts: str, delay: str, files: int = 1) -> DataFrame:
    """One stream of several sources with a watermark each: the time of the whole is that of the slowest source (policy ``min``).

    ``sources``: by name, the folder of its rows and the folder of its heartbeats (see ``release_idle``). Rows of a source that lags are
    not late, which they would be under one watermark for all. Columns ``__source`` and ``__beat`` are added. Sets the policy on the
    session: use one that runs no stream of another policy.
    """
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    out = None
    for name, (rows, beats) in sorted(sources.items()):
        real = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(rows).withColumn(BEAT, F.lit(False))
        tick = spark.readStream.schema(schema).parquet(beats).withColumn(BEAT, F.lit(True))
        mine = with_watermark(real.unionByName(tick), ts, delay).withColumn("__source", F.lit(name))
        out = mine if out is None else out.unionByName(mine)
    return out


def release_idle(spark: SparkSession, sources: Mapping[str, tuple[str, str]], schema: T.StructType, ts: str, idle: str) -> list[str]:
    """Heartbeats, so that silent sources hold back the time of the others no longer; returns the names of the silent ones.

    A source is silent when its newest row or heartbeat is more than ``idle`` older than the newest row of all. Its heartbeat stands at that
    newest time: a source that wakes up finds its rows late if they are older than the delay before it. Every other source gets one at its own
    newest time: a checkpoint holds the time of the whole only, so a run that starts from it would take a source without new rows for one
    that has not begun. Run it between two runs, when the rows that are there have been read. A source without any row is silent; rows
    without time do not count, and nothing is done where no source has a row. Only the time column is read.
    """
    newest = {}
    for name, folders in sources.items():
        newest[name] = [spark.read.schema(schema).parquet(f).select(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("us")).first()["us"] for f in folders]
    known = [rows for rows, _ in newest.values() if rows is not None]
    if not known:
        return []
    top = max(known)
    own = {n: max((x for x in both if x is not None), default=None) for n, both in newest.items()}
    silent = sorted(n for n, x in own.items() if x is None or x < top - round(seconds(idle) * 1_000_000))
    for name in sources:
        when = F.timestamp_micros(F.lit(top if name in silent else own[name])).cast(schema[ts].dataType)
        beat = spark.range(1).select(*[(when if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
        beat.coalesce(1).write.mode("append").parquet(sources[name][1])
    return silent


# ---- windows ---------------------------------------------------------------------------------------

def stream_tumble(df: DataFrame, ts: str, size: str, keys: Keys | None, aggs: Aggs) -> DataFrame:
    return tumble(df, ts, size, keys, aggs)


def stream_hop(df: DataFrame, ts: str, slide: str, size: str, keys: Keys | None, aggs: Aggs) -> DataFrame:
    return hop(df, ts, slide, size, keys, aggs)


def stream_session(df: DataFrame, ts: str, gap: str, keys: Keys, aggs: Aggs) -> DataFrame:
    return session(df, ts, gap, keys, aggs)


def stream_tumble_max(df: DataFrame, ts: str, size: str, keys: Keys | None, by: Keys) -> DataFrame:
    """The record with the largest ``by`` in each window, NULL below all values; one record a window is held."""
    k = as_list(keys)
    record = F.struct(*[c for c in df.columns if c not in k])
    g = df.groupBy(F.window(ts, size).alias("w"), *k).agg(F.max_by(record, F.struct(*as_list(by))).alias("best"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *k, "best.*")


def stream_last_record(df: DataFrame, ts: str, size: str, keys: Keys, fields: Keys) -> DataFrame:
    return tumble_last_record(df, ts, size, keys, fields)


def stream_dedup_priority(df: DataFrame, keys: Keys, priority: Column, by: Keys) -> DataFrame:
    """The row of each key with the lowest priority number (NULL before all), then the largest ``by``.

    For update mode and an upsert sink: a key comes out again when a better row replaced its row. One row a key is held.
    """
    k = as_list(keys)
    record = F.struct(*[c for c in df.columns if c not in k])
    best = F.max_by(record, F.struct(priority.isNull(), -priority, *as_list(by)))
    return df.groupBy(*k).agg(best.alias("best")).select(*k, "best.*")


def stream_rolling_features(df: DataFrame, ts: str, keys: Keys, value: str, bucket: str = "1 hour", long_hours: int = 12,
                            short_hours: int = 6, together_hours: int = 4) -> DataFrame:
    """Two chained stateful windows: hourly buckets, then a sliding window over bucket times.

    The second state holds buckets, not windows: ``together_hours`` consecutive windows share one list of the buckets in their reach, so a bucket
    is written ``long_hours / together_hours + 1`` times instead of once for each window it lies in. They come out together when the watermark
    passes the last of them, so the first waits ``together_hours`` less a bucket longer than its own end; 1 lets every window of an hour out by itself.
    """
    k, step = as_list(keys), round(seconds(bucket) * 1_000_000)
    b = df.groupBy(F.window(ts, bucket).alias("w"), *k).agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("amt_sum"))
    b = b.select(*k, "cnt", "amt_sum", F.unix_micros(F.col("w.end")).alias("end"), F.window_time("w").alias("bucket_time"))
    reach = F.window("bucket_time", f"{long_hours + together_hours} hours", f"{together_hours} hours").alias("reach")
    x = b.groupBy(reach, *k).agg(F.collect_list(F.struct("end", "cnt", "amt_sum")).alias("buckets"))
    x = x.withColumns({"buckets": F.array_sort("buckets"), "last": F.unix_micros(F.col("reach.end"))})
    hour = 3_600_000_000
    # windows end at multiples of the bucket, as those of F.window do
    first = F.floor((F.col("last") - together_hours * hour) / step) * step + step
    x = x.withColumn("at", F.explode(F.when(first <= F.col("last"), F.sequence(first, F.col("last"), F.lit(step)))))
    within = lambda hours: F.filter("buckets", lambda y: (y["end"] <= F.col("at")) & (y["end"] >= F.col("at") - hours * hour))
    # the long horizon holds buckets that begin in the window, the short one those that end at its start too
    x = x.withColumn("buckets", F.filter("buckets", lambda y: (y["end"] <= F.col("at")) & (y["end"] > F.col("at") - long_hours * hour))).filter(F.size("buckets") > 0)
    total = lambda rows, c: F.aggregate(rows, F.lit(None).cast(b.schema[c].dataType), lambda a, y: F.coalesce(a + y[c], a, y[c]))
    s, l = f"{short_hours}h", f"{long_hours}h"
    return x.select(*k, F.timestamp_micros("at").alias("feature_time"), total(within(short_hours), "cnt").alias(f"cnt_{s}"), total("buckets", "cnt").alias(f"cnt_{l}"),
                    total(within(short_hours), "amt_sum").alias(f"amt_sum_{s}"), total("buckets", "amt_sum").alias(f"amt_sum_{l}"))


def processing_time_tumble(df: DataFrame, size: str, keys: Keys | None, aggs: Aggs) -> DataFrame:
    """Windows by the time a row is processed."""
    return tumble(df.withColumn("__now", F.current_timestamp()), "__now", size, keys, aggs)


def lateness_delay(out_of_order: str, lateness: str) -> str:
    return f"{seconds(out_of_order) + seconds(lateness)} seconds"


def allowed_lateness(df: DataFrame, ts: str, out_of_order: str, lateness: str) -> DataFrame:
    """Watermark that also waits ``lateness``: in update mode a late row fires its window again."""
    return with_watermark(df, ts, lateness_delay(out_of_order, lateness))


def split_late(spark: SparkSession, stream: DataFrame, ts: str, delay: str, on_time: str, late: str, marks: str, checkpoint: str) -> None:
    """Route late rows to their own table before any window drops them.

    Each micro-batch leaves a mark, the highest event time up to its end; rows older than the mark of the batch before
    less ``delay`` are late. Each batch writes its own folders, so a retry repeats the result.
    """
    def each(batch: DataFrame, i: int) -> None:
        high = spark.read.parquet(f"{marks}/_batch={i - 1}").first()[0] if i else None
        is_late = F.lit(False) if high is None else F.col(ts) < F.lit(high).cast(batch.schema[ts].dataType) - interval(seconds(delay))
        b = batch.withColumn("__late", F.coalesce(is_late, F.lit(False))).persist()
        try:
            b.filter("not __late").drop("__late").write.mode("overwrite").parquet(f"{on_time}/_batch={i}")
            b.filter("__late").drop("__late").write.mode("overwrite").parquet(f"{late}/_batch={i}")
            b.agg(F.greatest(F.max(ts), F.lit(high).cast(batch.schema[ts].dataType)).alias("high")).write.mode("overwrite").parquet(f"{marks}/_batch={i}")
        finally:
            b.unpersist()

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def split_late_batch(df: DataFrame, ts: str, arrival: str, delay: str) -> DataFrame:
    """Batch form: ``is_late`` by the running maximum of event time over *earlier* arrivals (arrival = a number)."""
    d = with_chunk(df, [], arrival)
    carry = carry_over(d, [], {"__m": F.max(ts)}, {"__before": ("max", "__m")})
    local = F.max(ts).over(Window.partitionBy(CHUNK).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1))
    out = attach(d.withColumn("__local", local), carry, [])
    late = F.col(ts) < F.greatest("__local", "__before") - interval(seconds(delay))
    return out.select(*df.columns, F.coalesce(late, F.lit(False)).alias("is_late"))


# ---- joins and dedup -------------------------------------------------------------------------------

def stream_join_interval(l: DataFrame, r: DataFrame, on: Keys, lts: str, rts: str, lo: str, hi: str, how: str = "inner") -> DataFrame:
    """Stream-stream join; both sides are watermarked, the time bound lets Spark drop old state."""
    k = as_list(on)
    rr = r.select(*[F.col(c).alias(f"__r_{c}") if c in k else F.col(c) for c in r.columns])
    lo_s = -seconds(lo[1:]) if lo.startswith("-") else seconds(lo)
    hi_s = -seconds(hi[1:]) if hi.startswith("-") else seconds(hi)
    cond = (F.col(rts) >= F.col(lts) + interval_signed(lo_s)) & (F.col(rts) <= F.col(lts) + interval_signed(hi_s))
    for c in k:
        cond = cond & (F.col(c) == F.col(f"__r_{c}"))
    return l.join(rr, cond, how).drop(*[f"__r_{c}" for c in k])


def interval_signed(secs: float) -> Column:
    return interval(secs) if secs >= 0 else -interval(-secs)


def dedup_ttl(df: DataFrame, keys: Keys) -> DataFrame:
    """First arrival per key within the watermark delay; older keys are forgotten."""
    return df.dropDuplicatesWithinWatermark(as_list(keys))


def lookup_each_batch(stream: DataFrame, load_dim: Callable[[], DataFrame], on: Keys, write: Callable[[DataFrame, DataFrame, int], None],
                      checkpoint: str) -> None:
    """Lookup join whose reference table is read again for every micro-batch: ``write(found, missing, batch_id)``."""
    from ..operators.joins import join_lookup

    def each(batch: DataFrame, i: int) -> None:
        found, missing = join_lookup(batch, load_dim(), on)
        write(found, missing, i)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class LookupCache:
    """Bounded copy of a reference table for a stream's lookups: keys used least recently go first, rows are fresh for ``ttl_s`` seconds.

    ``load(keys)`` gives the reference rows of a frame of distinct keys; it is asked only for keys the copy lacks (keys it does not know
    are remembered too). The copy lies in the shared folder, at most ``most`` keys of it. ``loads`` has the number of keys of each request.
    """

    def __init__(self, spark: SparkSession, load: Callable[[DataFrame], DataFrame], on: Keys, most: int, ttl_s: float):
        self.spark, self.load, self.on, self.most, self.ttl_s = spark, load, as_list(on), most, ttl_s
        self.path: str | None = None
        self.loads: list[int] = []

    def rows(self, batch: DataFrame) -> DataFrame:
        """Reference rows of all keys of a micro-batch; the copy moves on."""
        now, spark = time.time(), batch.sparkSession
        root = scratch_dir(self.spark, "lookup-cache")
        keys = batch.select(*self.on).dropna().distinct()
        lacking = keys
        if self.path is not None:
            have = spark.read.parquet(self.path).filter(F.col("__at") >= F.lit(now - self.ttl_s))
            lacking = keys.join(have.select(*self.on), self.on, "left_anti")
        lacking.write.parquet(f"{root}/lacking")
        lacking = spark.read.parquet(f"{root}/lacking")
        self.loads.append(lacking.count())
        told = self.load(lacking).withColumn("__found", F.lit(True))
        got = lacking.join(told, self.on, "left").withColumns({"__found": F.coalesce("__found", F.lit(False)), "__at": F.lit(now), "__used": F.lit(now)})
        if self.path is not None:
            asked = keys.withColumn("__asked", F.lit(now))
            kept = have.join(asked, self.on, "left").withColumn("__used", F.coalesce("__asked", "__used")).drop("__asked")
            got = got.select(kept.columns).unionByName(kept)
        got.write.parquet(f"{root}/all")
        all_ = spark.read.parquet(f"{root}/all")
        order = Window.partitionBy("__bucket").orderBy(F.col("__used").desc(), *self.on)
        # the most recent keys, ranked in parts of the key space that hold about equal numbers
        parts = max(1, self.most // 1_000_000)
        ranked = all_.withColumn("__bucket", F.pmod(F.xxhash64(*self.on), F.lit(parts))).withColumn("__rank", F.row_number().over(order))
        ranked.filter(F.col("__rank") <= self.most // parts).drop("__bucket", "__rank").write.parquet(f"{root}/kept")
        self.path = f"{root}/kept"
        return all_.filter("__found").join(keys, self.on, "left_semi").drop("__found", "__at", "__used")


def lookup_cached(stream: DataFrame, cache: LookupCache, write: Callable[[DataFrame, DataFrame, int], None], checkpoint: str) -> None:
    """Lookup join through a bounded cache: ``write(found, missing, batch_id)`` for every micro-batch."""
    from ..operators.joins import join_lookup

    def each(batch: DataFrame, i: int) -> None:
        found, missing = join_lookup(batch, cache.rows(batch), cache.on)
        write(found, missing, i)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
