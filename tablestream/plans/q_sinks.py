"""Sinks: tables written through the sink under test, then read back."""

from pyspark.sql import functions as F

from ..operators import aggs as A
from ..session import scratch_dir
from ..sinks import tables as K
from .registry import query

SPLIT = "timestamp_ntz'2024-01-15 00:00:00'"


@query("s11_append", "SELECT event_id, value FROM events")
def s11(t):
    p = scratch_dir(t.spark, "append")
    K.write_append(t.events.filter(f"ts < {SPLIT}").select("event_id", "value"), p)
    K.write_append(t.events.filter(f"ts >= {SPLIT}").select("event_id", "value"), p)
    return t.spark.read.parquet(p)


LATEST = "(SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)"


@query("s12_upsert", f"SELECT user_id, event_id, value FROM {LATEST} WHERE rn = 1")
def s12(t):
    """Two batches upserted by key; the second is written twice, as after a failure."""
    p = scratch_dir(t.spark, "upsert")
    e = t.events.select("user_id", "event_id", "value", "ts")
    K.write_upsert(e.filter(f"ts >= {SPLIT}"), p, "user_id", "ts", 1)       # newer rows first: order decides, not arrival
    for _ in range(2):
        K.write_upsert(e.filter(f"ts < {SPLIT}"), p, "user_id", "ts", 2)
    return K.read_upsert(t.spark, p, "user_id", "ts").drop("ts")


@query("s13_tombstone", f"SELECT user_id, event_id, value FROM {LATEST} WHERE rn = 1 AND event_type <> 'error'")
def s13(t):
    """Upsert with deletes, folded into a compacted target."""
    p = scratch_dir(t.spark, "tombstone")
    e = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    gone = F.col("event_type") == "error"
    K.write_upsert(e.filter(f"ts < {SPLIT}"), p, "user_id", "ts", 1, gone)
    K.write_upsert(e.filter(f"ts >= {SPLIT}"), p, "user_id", "ts", 2, gone)
    K.compact_upsert(t.spark, p, f"{p}-compact", "user_id", "ts")
    return K.read_upsert(t.spark, f"{p}-compact", "user_id", "ts").select("user_id", "event_id", "value")


@query("s14_retract", f"""WITH a AS (SELECT user_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-15') WHERE rn = 1),
    b AS (SELECT user_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-15') WHERE rn = 1)
    SELECT '+I' AS row_kind, user_id, value FROM a UNION ALL SELECT '-U', a.user_id, a.value FROM a JOIN b USING (user_id) UNION ALL
    SELECT CASE WHEN a.user_id IS NULL THEN '+I' ELSE '+U' END, b.user_id, b.value FROM b LEFT JOIN a USING (user_id)""")
def s14(t):
    """Changes of two batches as a retract log."""
    p = scratch_dir(t.spark, "retract")
    e = t.events.select("user_id", "event_id", "value", "ts")
    K.write_retract(e.filter(f"ts < {SPLIT}"), p, "user_id", "ts", 1)
    K.write_retract(e.filter(f"ts >= {SPLIT}"), p, "user_id", "ts", 2)
    return t.spark.read.parquet(p).select("row_kind", "user_id", "value")


@query("s16_csv_sink", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s16(t):
    p = scratch_dir(t.spark, "csv-sink")
    K.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), p)
    return t.spark.read.option("header", True).schema("c_custkey bigint, c_name string, c_acctbal double").csv(p)


@query("s17_discard_sink", "SELECT COUNT(*) AS n FROM orders")
def s17(t):
    """Whole rows computed and thrown away, next to their count."""
    K.write_noop(t.orders)
    return t.orders.agg(F.count(F.lit(1)).alias("n"))


@query("s18_fan_out", "SELECT 'all' AS sink, COUNT(*) AS n FROM events UNION ALL SELECT 'errors', COUNT(*) FROM events WHERE event_type = 'error'")
def s18(t):
    """One read, two sinks."""
    p = scratch_dir(t.spark, "fan-out")
    K.fan_out(t.events.select("event_id", "event_type"), {
        "all": lambda d: K.write_append(d, f"{p}/all"), "errors": lambda d: K.write_append(d.filter("event_type = 'error'"), f"{p}/errors")})
    from ..operators.relational import union_all
    return union_all([t.spark.read.parquet(f"{p}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("sink"), "n") for n in ("all", "errors")])


@query("s20_bucketed", "SELECT o_orderpriority, COUNT(*) AS n, SUM(l_quantity) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def s20(t):
    """Two tables bucketed on the join key: the join below needs no shuffle of its own."""
    p = scratch_dir(t.spark, "buckets")
    tag = p.rsplit("-", 1)[1]
    K.write_bucketed(t.orders.select("o_orderkey", "o_orderpriority"), f"b_orders_{tag}", "o_orderkey", 8, path=f"{p}/o")
    K.write_bucketed(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"), f"b_lines_{tag}", "o_orderkey", 8, path=f"{p}/l")
    j = t.spark.table(f"b_orders_{tag}").join(t.spark.table(f"b_lines_{tag}"), "o_orderkey")
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("s21_refresh_partition", """SELECT strftime(ts, '%Y-%m-%d') AS ds, COUNT(*) AS n, ROUND(SUM(CASE WHEN ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' THEN value ELSE 0 END), 2) AS total FROM events GROUP BY 1""")
def s21(t):
    """All days loaded with value 0, then one day refreshed: only its partition changes."""
    p = scratch_dir(t.spark, "partitions")
    e = t.events.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("ds"))
    K.refresh_partition(e.withColumn("value", F.lit(0.0)), p, "ds")
    K.refresh_partition(e.filter("ds = '2024-01-15'"), p, "ds")
    d = t.spark.read.schema("event_id bigint, value double, ds string").parquet(p)
    return d.groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("s23_materialize_full", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def s23(t):
    """Second full refresh replaces the first."""
    p = scratch_dir(t.spark, "materialized")
    K.materialize_full(lambda: A.agg(t.events.filter(f"ts < {SPLIT}"), "event_type", {"n": ("count", "*")}), p)
    K.materialize_full(lambda: A.agg(t.events, "event_type", {"n": ("count", "*")}), p)
    return K.read_materialized(t.spark, p)


@query("s23_materialize_stream", f"SELECT user_id, event_id, value FROM {LATEST} WHERE rn = 1")
def s23b(t):
    """Continuous refresh: the stream's micro-batches are upserted."""
    from ..sources.files import read_table_stream
    p = scratch_dir(t.spark, "continuous")
    s = read_table_stream(t.spark, t.folder, "events", t.events.schema).select("user_id", "event_id", "value", "ts")
    K.materialize_stream(s, f"{p}/t", f"{p}/c", "user_id", "ts").awaitTermination()
    return K.read_upsert(t.spark, f"{p}/t", "user_id", "ts").drop("ts")


@query("s24_incremental", "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS ids FROM events")
def s24(t):
    """Load up to a date, then everything newer, then again (nothing new)."""
    p = scratch_dir(t.spark, "incremental")
    e = t.events.select("event_id", "ts")
    K.incremental_append(e.filter(f"ts < {SPLIT}"), p, "ts")
    K.incremental_append(e, p, "ts")
    K.incremental_append(e, p, "ts")
    return t.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("s25_layers", """WITH s AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1)
    SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM s JOIN customer ON user_id = c_custkey GROUP BY event_type""")
def s25(t):
    """raw -> deduplicated source -> enriched -> fact, each layer written."""
    from ..operators.dedup import dedup_last
    read = K.layers(t.spark, scratch_dir(t.spark, "layers"), {
        "raw": lambda _: t.events,
        "src": lambda r: dedup_last(r("raw"), ["user_id", "event_type"], "ts"),
        "int": lambda r: r("src").join(t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment"), "user_id"),
        "fct": lambda r: r("int").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))})
    return read("fct")


@query("s26_time_travel", "SELECT user_id, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-15') WHERE rn = 1")
def s26(t):
    """State as of a commit time between two batches."""
    p = scratch_dir(t.spark, "travel")
    e = t.events.select("user_id", "event_id", "value", "ts")
    K.write_upsert(e.filter(f"ts < {SPLIT}"), p, "user_id", "ts", 1, committed_at="2024-02-01 00:00:00")
    K.write_upsert(e.filter(f"ts >= {SPLIT}"), p, "user_id", "ts", 2, committed_at="2024-02-02 00:00:00")
    return K.read_as_of(t.spark, p, "user_id", "ts", "2024-02-01 12:00:00").drop("ts")
