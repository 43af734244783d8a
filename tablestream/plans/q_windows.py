"""Time windows."""

from pyspark.sql import functions as F

from ..operators import aggs as A, nested as NE, temporal as T, windows as W
from ..operators.core import interval
from .registry import query

CNT = {"n": ("count", "*")}
N_SUM = {"n": ("count", "*"), "total": ("sum", "value")}


def rounded(d, *cols):
    return d.withColumns({c: F.round(c, 2) for c in (cols or ("total",))})


def tb(size, col="ts"):
    return f"time_bucket(INTERVAL '{size}', {col}, TIMESTAMP '1970-01-01')"


@query("w01_tumble", f"""SELECT {tb('1 hour')} AS window_start, {tb('1 hour')} + INTERVAL '1 hour' AS window_end, event_type, COUNT(*) AS n,
    ROUND(SUM(value), 2) AS total, ROUND(SUM(value), 2) / COUNT(*) AS mean FROM events GROUP BY ALL""")
def w01(t):
    d = rounded(W.tumble(t.events, "ts", "1 hour", "event_type", N_SUM))
    return d.withColumn("mean", F.col("total") / F.col("n"))


HOP_SQL = """WITH s AS (SELECT unnest(generate_series({b} - (INTERVAL '{slide}' * {k}), {b}, INTERVAL '{slide}')) AS window_start, {cols} FROM events)
    SELECT window_start, window_start + INTERVAL '{size}' AS window_end, {sel} FROM s GROUP BY ALL"""


@query("w02_hop", HOP_SQL.format(b=tb("10 minutes"), slide="10 minutes", k=5, size="1 hour", cols="user_id, value", sel="user_id, COUNT(*) AS n, ROUND(SUM(value), 2) AS total"))
def w02(t):
    """1-hour windows every 10 minutes, through 10-minute panes."""
    return rounded(W.hop(t.events, "ts", "10 minutes", "1 hour", "user_id", N_SUM))


@query("w02_hop_direct", HOP_SQL.format(b=tb("6 hours"), slide="6 hours", k=1, size="12 hours", cols="event_type, value", sel="event_type, MIN(value) AS low, MAX(value) AS high"))
def w02b(t):
    return W.hop(t.events, "ts", "6 hours", "12 hours", "event_type", {"low": ("min", "value"), "high": ("max", "value")})


@query("w03_cumulate", f"""WITH s AS (SELECT {tb('1 day')} AS window_start, unnest(generate_series({tb('4 hours')} + INTERVAL '4 hours', {tb('1 day')} + INTERVAL '1 day', INTERVAL '4 hours')) AS window_end, event_type, value FROM events)
    SELECT window_start, window_end, event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM s GROUP BY ALL""")
def w03(t):
    return rounded(W.cumulate(t.events, "ts", "4 hours", "1 day", "event_type", N_SUM))


def session_sql(gap, cols, sel):
    return f"""WITH a AS (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL '{gap}' THEN 1 ELSE 0 END AS fresh FROM events),
    b AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM a)
    SELECT user_id, MIN(ts) AS window_start, {sel} FROM b GROUP BY user_id, sid"""


@query("w04_session", session_sql("8 hours", "", "MAX(ts) + INTERVAL '8 hours' AS window_end, COUNT(*) AS n, ROUND(SUM(value), 2) AS total"))
def w04(t):
    return rounded(W.session(t.events, "ts", "8 hours", "user_id", N_SUM))


@query("w05_session_collect", """WITH a AS (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL '8 hours' THEN 1 ELSE 0 END AS fresh FROM events),
    b AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM a),
    c AS (SELECT *, MIN(ts) OVER s AS session_start, MAX(ts) OVER s AS last_ts, CAST((ROW_NUMBER() OVER (PARTITION BY user_id, sid ORDER BY ts, event_id) - 1) // 3 AS INTEGER) AS part FROM b WINDOW s AS (PARTITION BY user_id, sid))
    SELECT user_id, session_start, last_ts, part, CAST(trunc(epoch(last_ts - session_start)) AS BIGINT) AS session_seconds, string_agg(event_type, '>' ORDER BY ts, event_id) AS items FROM c GROUP BY ALL""")
def w05(t):
    """Sessions with their event types in order, lists of three so that the continuation is exercised."""
    return W.session_collect(t.events, "ts", "8 hours", "user_id", "event_type", "event_id", part_rows=3).withColumn("items", F.array_join("items", ">"))


@query("w06_session_drop", "WITH s AS (" + session_sql("4 hours", "", "MAX(ts) + INTERVAL '4 hours' AS window_end, CAST(trunc(epoch(MAX(ts) - MIN(ts))) AS BIGINT) AS sec") + """),
    r AS (SELECT user_id, window_end, AVG(sec) OVER (PARTITION BY user_id ORDER BY window_end RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW) AS short_avg,
      AVG(sec) OVER (PARTITION BY user_id ORDER BY window_end RANGE BETWEEN INTERVAL '7 days' PRECEDING AND CURRENT ROW) AS long_avg FROM s)
    SELECT user_id, window_end, ROUND(short_avg, 4) AS short_avg, ROUND(long_avg, 4) AS long_avg FROM r WHERE short_avg < long_avg * 0.5""")
def w06(t):
    d = W.session_drop_alert(t.events, "ts", "4 hours", "user_id", "1 day", "7 days", 0.5)
    return d.select("user_id", "window_end", F.round("short_avg", 4).alias("short_avg"), F.round("long_avg", 4).alias("long_avg"))


@query("w07_rolling_features", f"""WITH b AS (SELECT user_id, {tb('1 hour')} AS bs, COUNT(*) AS cnt, ROUND(SUM(value), 2) AS amt FROM events GROUP BY ALL),
    s AS (SELECT user_id, bs + INTERVAL '1 hour' AS bucket_end, cnt, amt, unnest(generate_series(bs - INTERVAL '11 hours', bs, INTERVAL '1 hour')) + INTERVAL '12 hours' AS feature_time FROM b)
    SELECT user_id, feature_time, CAST(SUM(cnt) FILTER (WHERE bucket_end >= feature_time - INTERVAL '6 hours') AS BIGINT) AS cnt_6h, CAST(SUM(cnt) AS BIGINT) AS cnt_12h,
      ROUND(SUM(amt) FILTER (WHERE bucket_end >= feature_time - INTERVAL '6 hours'), 2) AS amt_sum_6h, ROUND(SUM(amt), 2) AS amt_sum_12h FROM s GROUP BY user_id, feature_time""")
def w07(t):
    return rounded(W.rolling_features(t.events, "ts", "user_id", "value", round_to=2), "amt_sum_6h", "amt_sum_12h")


@query("w08_window_rows", f"""WITH r AS (SELECT *, {tb('1 day')} AS window_start, CAST((ROW_NUMBER() OVER (PARTITION BY {tb('1 day')}, user_id ORDER BY ts, event_id) - 1) // 2 AS INTEGER) AS part FROM events)
    SELECT window_start, user_id, part, string_agg(event_type || '@' || event_id, ',' ORDER BY ts, event_id) AS rows FROM r GROUP BY ALL""")
def w08(t):
    """Rows of each (day, user) as arrays of at most two."""
    d = W.tumble_collect_rows(t.events.select("ts", "user_id", "event_id", "event_type"), "ts", "1 day", "user_id", ["event_id", "event_type"], "event_id", part_rows=2)
    return d.select("window_start", "user_id", "part", F.array_join(F.transform("items", lambda x: F.concat_ws("@", x["event_type"], x["event_id"])), ",").alias("rows"))


@query("w09_batch_messages", f"""WITH m AS (SELECT {tb('1 hour')} AS window_start, CAST(user_id % 5 AS INTEGER) AS bucket, event_id, ts, event_type || ':' || event_id AS val FROM events WHERE event_type <> 'error'),
    p AS (SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY window_start, bucket ORDER BY ts, event_id) - 1) // 4 AS INTEGER) AS part FROM m)
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, 'b' || bucket AS key, part, COUNT(*) AS n, string_agg(val, chr(10) ORDER BY ts, event_id) AS val FROM p GROUP BY window_start, bucket, part""")
def w09(t):
    """Payloads per (hour, bucket) without deletes, at most four messages each so that the part split is exercised."""
    e = t.events.withColumn("val", F.concat_ws(":", "event_type", "event_id"))
    return W.batch_messages(e, "ts", F.col("user_id"), "val", 5, "event_id", "1 hour", F.col("event_type") != "error", max_rows=4)


@query("w10_monthly", f"SELECT {tb('30 days')} AS window_start, user_id, ROUND(SUM(value), 2) AS total FROM events GROUP BY ALL")
def w10(t):
    """30-day totals, aligned to 1970-01-01 (not calendar months)."""
    return rounded(W.tumble(t.events, "ts", "30 days", "user_id", N_SUM)).select("window_start", "user_id", "total")


@query("w11_tumble_distinct", f"SELECT {tb('6 hours')} AS window_start, event_type, COUNT(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def w11(t):
    return W.tumble_distinct(t.events, "ts", "6 hours", "event_type", "user_id", "users").drop("window_end")


@query("w12_tumble_max", f"""SELECT window_start, event_id, user_id, value FROM (SELECT *, {tb('1 day')} AS window_start, ROW_NUMBER() OVER (PARTITION BY {tb('1 day')} ORDER BY value DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def w12(t):
    return W.tumble_max(t.events, "ts", "1 day", None, ["value", "event_id"]).select("window_start", "event_id", "user_id", "value")


@query("w15_heartbeat", f"SELECT {tb('1 hour')} AS window_start, user_id, COUNT(*) AS n FROM events GROUP BY ALL")
def w15(t):
    """Heartbeat rows advance time and leave no trace in the counts."""
    e = t.events.select("ts", "user_id")
    beats = e.agg((F.max("ts") + interval(86400)).alias("ts"))
    d = W.add_heartbeat(e, beats, "ts")
    w = W.tumble(d, "ts", "1 hour", "user_id", {"n": ("count", "*"), "real": ("count_if", "not is_heartbeat")})
    return w.filter("real > 0").select("window_start", "user_id", F.col("real").alias("n"))


@query("w18_count_window", """WITH p AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS window_no FROM events)
    SELECT user_id, window_no, ROUND(SUM(value), 2) AS total FROM p GROUP BY ALL HAVING COUNT(*) = 10""")
def w18(t):
    return rounded(W.count_window(t.events.select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], 10, {"total": ("sum", "value")}))


@query("w19_apply_window", f"""SELECT {tb('1 day')} AS window_start, user_id, COUNT(*) AS n, ROUND(MAX(value) - MIN(value), 2) AS spread FROM events GROUP BY ALL""")
def w19(t):
    """A function called with all rows of each (day, user)."""
    def spread(key, parts):
        n, low, high = 0, float("inf"), float("-inf")
        for p in parts:
            v = p["value"].to_numpy()
            n, low, high = n + len(v), min(low, float(v.min())), max(high, float(v.max()))
        yield key[0], key[2], n, round(high - low, 2)

    e = t.events.select("ts", "user_id", "value")
    return W.apply_window(e, "ts", "1 day", "user_id", spread, "window_start timestamp_ntz, user_id bigint, n bigint, spread double")


@query("w20_evict", f"""WITH a AS (SELECT *, {tb('1 day')} AS window_start, MAX(ts) OVER (PARTITION BY {tb('1 day')}, event_type) AS newest FROM events),
    b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM a WHERE ts >= newest - INTERVAL '3 hours')
    SELECT window_start, event_type, event_id FROM b WHERE rn <= 4""")
def w20(t):
    return W.evict(t.events, "ts", "1 day", "event_type", last_n=4, last_t="3 hours", tie="event_id").select("window_start", "event_type", "event_id")


@query("w22_avg_volume", f"""WITH l AS (SELECT l_orderkey, l_partkey, l_quantity, o_orderdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    pr AS (SELECT l_partkey, l_shipdate AS p_ts, MAX(l_extendedprice) AS price FROM lineitem GROUP BY ALL),
    j AS (SELECT l.*, pr.price FROM l ASOF LEFT JOIN pr ON l.l_partkey = pr.l_partkey AND l.o_orderdate >= pr.p_ts)
    SELECT {tb('30 days', 'o_orderdate')} AS window_start, CAST(l_partkey % 10 AS INTEGER) AS grp, COUNT(*) AS n, COUNT(price) AS priced, SUM(l_quantity) / COUNT(*) AS avg_qty FROM j GROUP BY ALL""")
def w22(t):
    """Order lines with the price version valid at order time, averaged per 30-day window and part group."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(o, "l_orderkey")
    pr = t.lineitem.groupBy("l_partkey", F.col("l_shipdate").alias("p_ts")).agg(F.max("l_extendedprice").alias("price"))
    j = T.join_asof(l, pr, "l_partkey", "o_orderdate", "p_ts").withColumn("grp", (F.col("l_partkey") % 10).cast("int"))
    d = W.tumble(j, "o_orderdate", "30 days", "grp", {"n": ("count", "*"), "priced": ("count", "price"), "qty": ("sum", "l_quantity")})
    return d.select("window_start", "grp", "n", "priced", (F.col("qty") / F.col("n")).alias("avg_qty"))


@query("w23_counts_after_unnest", f"""WITH o AS (SELECT o_orderkey, o_orderdate, unnest(string_split(o_orderpriority, '-')) AS word FROM orders)
    SELECT {tb('1 day', 'o_orderdate')} AS window_start, word, COUNT(*) AS n FROM o GROUP BY ALL""")
def w23(t):
    o = t.orders.select("o_orderdate", F.split("o_orderpriority", "-").alias("words"))
    return W.tumble(NE.unnest(o, "words", "word"), "o_orderdate", "1 day", "word", CNT).drop("window_end")


@query("w24_time_filter", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL '3 days' AND ts <= TIMESTAMP '2024-01-20' - INTERVAL '2 hours'")
def w24(t):
    return W.time_filter(t.events, "ts", "2024-01-20 00:00:00", newer_than="3 days", older_than="2 hours").select("event_id")


@query("w25_last_record", f"""WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v FROM events)
    SELECT {tb('1 day')} AS window_start, user_id, COUNT(*) AS n, arg_max(event_type, ts) AS last_event_type, arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS last_v FROM e GROUP BY ALL""")
def w25(t):
    e = t.events.withColumn("v", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return W.tumble_last_record(e, "ts", "1 day", "user_id", ["event_type", "v"]).drop("window_end")
