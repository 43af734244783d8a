"""OVER windows."""

from pyspark.sql import functions as F

from ..operators import over as O, windows as W
from .registry import query



@query("o01_over_range", """SELECT event_id, COUNT(*) OVER w AS n, ROUND(SUM(value) OVER w, 2) AS total FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW)""")
def o01(t):
    d = O.over_range(t.events.select("event_id", "user_id", "ts", "value"), "user_id", "ts", "1 day", {"n": ("count", "*"), "total": ("sum", "value")})
    return d.select("event_id", "n", F.round("total", 2).alias("total"))


@query("o02_over_rows", """SELECT event_id, COUNT(*) OVER w AS n, MAX(value) OVER w AS top FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)""")
def o02(t):
    d = O.over_rows(t.events.select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], 10, {"n": F.count(F.lit(1)), "top": F.max("value")}, block=25)
    return d.select("event_id", "n", "top")


@query("o03_running_total", """SELECT event_id, ROUND(s, 2) AS running_total, s > 500 AS over_threshold FROM
    (SELECT event_id, SUM(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::DOUBLE AS s FROM events)""")
def o03(t):
    d = O.running_total(t.events.select("event_id", "user_id", "ts", F.col("value").cast("decimal(12,2)").alias("value")), "user_id", ["ts", "event_id"], "value", threshold=500)
    return d.select("event_id", F.col("running_total").cast("double").alias("running_total"), "over_threshold")


@query("o03_rolling_flag", """SELECT event_id, ROUND(s, 2) AS total_value, CASE WHEN ROUND(s, 2) > 100 THEN 'YES' ELSE 'NO' END AS flag FROM (SELECT event_id, SUM(value) OVER
    (PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW) AS s FROM events)""")
def o03b(t):
    d = O.over_range(t.events.select("event_id", "user_id", "event_type", "ts", "value"), ["user_id", "event_type"], "ts", "1 day", {"total_value": ("sum", "value")})
    total = F.round("total_value", 2)
    return d.select("event_id", total.alias("total_value"), F.when(total > 100, "YES").otherwise("NO").alias("flag"))


@query("o04_lag", "SELECT event_id, value, LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_value FROM events")
def o04(t):
    return O.lag(t.events.select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], "value", "previous_value").select("event_id", "value", "previous_value")


@query("o05_on_change", """SELECT event_id, event_type FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
    WHERE prev IS NULL OR event_type <> prev""")
def o05(t):
    return O.on_change(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "event_type")


LOCF = "CASE WHEN event_id % 3 <> 0 THEN NULL ELSE value END"


@query("o06_locf", f"""SELECT event_id, LAST_VALUE(v IGNORE NULLS) OVER w AS v, LAST_VALUE(k IGNORE NULLS) OVER w AS k FROM
    (SELECT *, {LOCF} AS v, CASE WHEN event_id % 5 <> 0 THEN NULL ELSE event_type END AS k FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def o06(t):
    e = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"),
                        F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("k"))
    return O.locf(e, "user_id", ["ts", "event_id"], ["v", "k"]).select("event_id", "v", "k")


@query("o07_locf_max", f"SELECT user_id, MAX(c) AS v FROM (SELECT user_id, LAST_VALUE({LOCF} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS c FROM events) GROUP BY user_id")
def o07(t):
    e = t.events.select("user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"))
    return O.locf_max(e, "user_id", "ts", "v")


@query("o08_row_number", "SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events")
def o08(t):
    return O.row_number(t.events.select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"]).select("event_id", "rn")


@query("o09_dense_rank", "SELECT l_orderkey, l_linenumber, l_partkey, DENSE_RANK() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS rank FROM lineitem")
def o09(t):
    return O.dense_rank(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_suppkey", "l_quantity").select("l_orderkey", "l_linenumber", "l_partkey", "rank")


@query("o10_over_partition", """SELECT event_id, MIN(ts) OVER (PARTITION BY user_id) AS first_seen, MAX(value) OVER (PARTITION BY user_id) AS top FROM events""")
def o10(t):
    return O.over_partition(t.events.select("event_id", "user_id", "ts", "value"), "user_id", {"first_seen": F.min("ts"), "top": F.max("value")}).select("event_id", "first_seen", "top")


@query("o11_window_delta", """WITH w AS (SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY ALL)
    SELECT window_start, event_type, n, LAG(n) OVER k AS prev_value, n - LAG(n) OVER k AS delta FROM w WINDOW k AS (PARTITION BY event_type ORDER BY window_start)""")
def o11(t):
    a = W.tumble(t.events, "ts", "6 hours", "event_type", {"n": ("count", "*")})
    return O.window_delta(a, "event_type", "window_start", "n").drop("window_end")


@query("o12_daily_change", """WITH d AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, COUNT(*) AS n FROM events GROUP BY 1) SELECT day, n, n - LAG(n) OVER (ORDER BY day) AS change FROM d""")
def o12(t):
    """Day-over-day change: ordered over the one-row-per-day aggregate only."""
    d = W.tumble(t.events, "ts", "1 day", None, {"n": ("count", "*")})
    x = O.lag(d, [], "window_start", "n", "prev")
    return x.select(F.col("window_start").alias("day"), "n", (F.col("n") - F.col("prev")).alias("change"))


@query("o13_crossing_alerts", """WITH r AS (SELECT event_id, user_id, ts, ROUND(SUM(value) OVER w, 2) AS total, COUNT(*) OVER w AS n FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1 day' PRECEDING AND CURRENT ROW)),
    l AS (SELECT *, LAG(total) OVER k AS tl, LAG(n) OVER k AS nl FROM r WINDOW k AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, 'BLOCK' AS action, ts AS updated_at FROM l WHERE (total > 300 AND tl <= 300) OR (n > 5 AND nl <= 5)
    UNION ALL SELECT user_id, 'UNBLOCK' AS action, ts AS updated_at FROM l WHERE (total <= 300 AND tl > 300) OR (n <= 5 AND nl > 5)""")
def o13(t):
    return O.crossing_alerts(t.events, "user_id", ["ts", "event_id"], "1 day", "value", 300, 5).drop("event_id")


@query("o14_named_window", """SELECT event_id, MIN(value) OVER w AS low, MAX(value) OVER w AS high, COUNT(*) OVER w AS n FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '12 hours' PRECEDING AND CURRENT ROW)""")
def o14(t):
    aggs = {"low": ("min", "value"), "high": ("max", "value"), "n": ("count", "*")}
    return O.over_range(t.events.select("event_id", "user_id", "ts", "value"), "user_id", "ts", "12 hours", aggs).select("event_id", *aggs)
