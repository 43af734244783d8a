"""Patterns, bursts, gaps."""

from pyspark.sql import functions as F

from ..operators import patterns as X
from ..operators.core import interval, tasks_for
from ..operators.temporal import missing_followup
from .registry import query


@query("x01_match_runs", """WITH RECURSIVE e AS (SELECT event_type, ts, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT DISTINCT event_type, 0::BIGINT AS rn, NULL::TIMESTAMP AS st, NULL::TIMESTAMP AS la, 0.0::DOUBLE AS s, 0::BIGINT AS n, NULL::TIMESTAMP AS o_st, NULL::TIMESTAMP AS o_la, NULL::DOUBLE AS o_avg, NULL::BIGINT AS o_n FROM events
      UNION ALL SELECT e.event_type, e.rn, CASE WHEN (s + value) / (n + 1) < 35 THEN COALESCE(st, ts) END, CASE WHEN (s + value) / (n + 1) < 35 THEN ts END, CASE WHEN (s + value) / (n + 1) < 35 THEN s + value ELSE 0 END,
        CASE WHEN (s + value) / (n + 1) < 35 THEN n + 1 ELSE 0 END, CASE WHEN (s + value) / (n + 1) >= 35 AND n > 0 THEN st END, CASE WHEN (s + value) / (n + 1) >= 35 AND n > 0 THEN la END,
        CASE WHEN (s + value) / (n + 1) >= 35 AND n > 0 THEN s / n END, CASE WHEN (s + value) / (n + 1) >= 35 AND n > 0 THEN n END FROM r JOIN e ON r.event_type = e.event_type AND e.rn = r.rn + 1)
    SELECT event_type, o_st AS start_ts, o_la AS last_ts, ROUND(o_avg * o_n, 2) AS total, o_n AS n FROM r WHERE o_n IS NOT NULL""")
def x01(t):
    """Runs of events per type whose running average stays under 35, ended by the event that breaks it."""
    d = X.match_runs(t.events, "event_type", "ts", "value", 35.0, tie="event_id")
    return d.select("event_type", "start_ts", "last_ts", F.round(F.col("avg_value") * F.col("n"), 2).alias("total"), "n")


@query("x02_sequence_strict", """WITH e AS (SELECT event_id, user_id, event_type, ts, LEAD(event_type) OVER w AS n1, LEAD(ts) OVER w AS t1, LEAD(event_id) OVER w AS i1 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, 'a:' || event_id || '>b:' || i1 AS matched FROM e WHERE event_type = 'view' AND n1 = 'purchase' AND t1 - ts <= INTERVAL '12 hours'""")
def x02a(t):
    """view directly followed by purchase within 12 hours."""
    is_kind = lambda k: F.col("event_type") == k
    d = X.match_sequence(t.events, "user_id", "ts", [X.Stage("a", is_kind("view")), X.Stage("b", is_kind("purchase"), "next")], "12 hours", tie="event_id", id_col="event_id")
    return d.select("user_id", F.array_join("matched", ">").alias("matched"))


@query("x02_sequence_relaxed", """WITH a AS (SELECT * FROM events WHERE event_type = 'view'), b AS (SELECT * FROM events WHERE event_type = 'purchase'), c AS (SELECT * FROM events WHERE event_type = 'error'),
    ab AS (SELECT a.user_id, a.event_id AS a_id, a.ts AS a_ts, arg_min(b.event_id, b.ts) AS b_id, MIN(b.ts) AS b_ts FROM a JOIN b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL '2 days' GROUP BY ALL)
    SELECT ab.user_id, 'a:' || a_id || '>b:' || b_id || '>c:' || c.event_id AS matched FROM ab JOIN c ON ab.user_id = c.user_id AND c.ts > b_ts AND c.ts <= a_ts + INTERVAL '2 days'""")
def x02b(t):
    """view, then the first purchase after it, then any later error, all within 2 days."""
    is_kind = lambda k: F.col("event_type") == k
    stages = [X.Stage("a", is_kind("view")), X.Stage("b", is_kind("purchase"), "followed_by"), X.Stage("c", is_kind("error"), "followed_by_any")]
    d = X.match_sequence(t.events, "user_id", "ts", stages, "2 days", tie="event_id", id_col="event_id")
    return d.select("user_id", F.array_join("matched", ">").alias("matched"))


@query("x02_sequence_dearer", """WITH a AS (SELECT * FROM events WHERE event_type = 'view'), b AS (SELECT * FROM events WHERE event_type = 'purchase')
    SELECT a.user_id, 'a:' || a.event_id || '>b:' || arg_min(b.event_id, b.ts) AS matched FROM a JOIN b ON a.user_id = b.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL '2 days' AND b.value > a.value GROUP BY a.user_id, a.event_id""")
def x02c(t):
    """view, then the first later purchase dearer than it within 2 days: a condition on a matched row."""
    return X.match_sequence(t.events, "user_id", "ts", dearer(), "2 days", tie="event_id", id_col="event_id", value="value").select("user_id", F.array_join("matched", ">").alias("matched"))


def dearer():
    is_kind = lambda k: F.col("event_type") == k
    return [X.Stage("a", is_kind("view")), X.Stage("b", is_kind("purchase"), relative=(">", "a", "first"))]


@query("x03_repeat_purchase", """SELECT event_id, event_type FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p = event_type""")
def x03(t):
    return X.repeat_purchase(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "event_type")


@query("x04_repeat_within", """SELECT event_id, prev_ts FROM (SELECT *, LAG(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev_ts FROM events) WHERE ts - prev_ts <= INTERVAL '1 day'""")
def x04(t):
    return X.repeat_within(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id", "event_type", "ts", "1 day", "event_id").select("event_id", "prev_ts")


@query("x05_burst", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY ALL HAVING COUNT(*) > 5")
def x05(t):
    return X.burst(t.events, "event_type", "ts", 5, "1 hour").drop("window_end")


FLAP = """SELECT window_start, user_id, CAST(SUM(CASE WHEN p <> event_type THEN 1 ELSE 0 END) AS BIGINT) AS changes FROM
    (SELECT *, time_bucket(INTERVAL '1 day', ts) AS window_start, LAG(event_type) OVER (PARTITION BY user_id, time_bucket(INTERVAL '1 day', ts) ORDER BY ts, event_id) AS p FROM events)
    GROUP BY ALL HAVING SUM(CASE WHEN p <> event_type THEN 1 ELSE 0 END) >= 2"""


@query("x06_flapping", FLAP)
def x06(t):
    return X.flapping(t.events, "user_id", ["ts", "event_id"], "event_type", 2, "1 day").drop("window_end")


@query("x07_fraud_alarms", f"""SELECT CAST(user_id AS VARCHAR) AS subject, 'ALARMED_CUSTOMER' AS alarm, ts AS at FROM events JOIN customer ON user_id = c_custkey WHERE c_acctbal < 0 UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'LOST_CARD', ts FROM events WHERE event_id % 97 IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'TOO_MANY_TX', time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' FROM events GROUP BY user_id, time_bucket(INTERVAL '1 day', ts) HAVING COUNT(*) > 5 UNION ALL
    SELECT CAST(user_id AS VARCHAR), 'CITY_CHANGES', window_start + INTERVAL '1 day' FROM ({FLAP})""")
def x07(t):
    tx = t.events.withColumn("card", F.col("event_id") % 97)
    alarmed = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    lost = t.supplier.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("card"))
    return X.fraud_alarms(tx, "user_id", "card", "event_type", ["ts", "event_id"], alarmed, lost, 5, 2, "1 day")


@query("x08_missing_followup", """SELECT v.event_id FROM events v WHERE v.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id
    AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL '6 hours')""")
def x08(t):
    k = F.col("event_type")
    return missing_followup(t.events, "user_id", "ts", k == "view", k == "purchase", "6 hours").select("event_id")


@query("x09_cutoff", """WITH tr AS (SELECT DISTINCT time_bucket(INTERVAL '1 day', ts) + INTERVAL '11 hours 30 minutes' AS cutoff_ts FROM events),
    d AS (SELECT cutoff_ts, e.*, ROW_NUMBER() OVER (PARTITION BY cutoff_ts, user_id ORDER BY ts DESC) AS rn FROM tr JOIN events e ON ts BETWEEN cutoff_ts - INTERVAL '24 hours' AND cutoff_ts),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS rn FROM events)
    SELECT user_id, event_id, ts, event_type FROM r WHERE rn = 1 UNION ALL
    SELECT user_id, event_id, cutoff_ts, 'proactive_no_event' FROM d WHERE rn = 1 AND ts <= cutoff_ts - INTERVAL '2 hours'""")
def x09(t):
    """Daily 11:30 cutoff: users heard of in the last day but silent for two hours, next to received first events."""
    from ..operators.dedup import first_per_value
    e = t.events.select("user_id", "event_id", "ts", "event_type")
    tr = e.select((F.col("ts").cast("date").cast("timestamp_ntz") + interval(11.5 * 3600)).alias("cutoff_ts")).distinct()
    return X.cutoff(e, tr, "user_id", "ts", "cutoff_ts", first_per_value(e, "user_id", "event_type", "ts"))


@query("x12_eta_history", """SELECT l_orderkey, string_agg(strftime(l_shipdate, '%Y-%m-%d') || '/' || l_linestatus, ',' ORDER BY l_shipdate, l_linenumber, l_linestatus) AS history, MAX(l_shipdate) + INTERVAL '1 day' AS eta_window_start,
    MAX(l_shipdate) + INTERVAL '26 hours' AS eta_window_end, MAX(l_returnflag) AS shipment_status FROM lineitem GROUP BY l_orderkey""")
def x12(t):
    """Shipment history per order with its delivery estimate."""
    d = X.eta_history(t.lineitem, "l_orderkey", "l_shipdate", ["l_linenumber", "l_linestatus"], "l_linestatus", "l_returnflag")
    h = F.transform("event_history", lambda x: F.concat_ws("/", F.date_format(x["l_shipdate"], "yyyy-MM-dd"), x["l_linestatus"]))
    return d.select("l_orderkey", F.array_join(h, ",").alias("history"), "eta_window_start", "eta_window_end", "shipment_status")


@query("x13_completeness", """WITH t AS (SELECT o_custkey % 20 AS server, o_orderkey AS tx, CASE WHEN o_orderkey % 50 = 0 THEN 9 ELSE 1 END AS want, o_orderdate AS created FROM orders WHERE o_totalprice <= 480000),
    e AS (SELECT l_orderkey AS tx, COUNT(DISTINCT l_linenumber) AS have FROM lineitem GROUP BY 1),
    g AS (SELECT server, t.tx, created <= TIMESTAMP '2000-01-01' - INTERVAL '2 hours' AS old, SUM(GREATEST(want - COALESCE(have, 0), 0)) OVER (PARTITION BY server ORDER BY t.tx) AS missing,
      CASE WHEN want < COALESCE(have, 0) THEN 1 ELSE 0 END AS over, ROW_NUMBER() OVER (PARTITION BY server, created <= TIMESTAMP '2000-01-01' - INTERVAL '2 hours' ORDER BY t.tx) - 1 AS rel FROM t LEFT JOIN e ON t.tx = e.tx),
    h AS (SELECT *, MIN(CASE WHEN NOT old THEN tx END) OVER (PARTITION BY server) AS new_start FROM g),
    i AS (SELECT *, missing = 0 AS complete, CASE WHEN NOT old THEN tx - rel = new_start END AS contiguous, CASE WHEN old THEN tx - rel END AS old_missing FROM h),
    k AS (SELECT *, complete AND (COALESCE(contiguous, false) OR old) AS loadable FROM i)
    SELECT server, MIN(tx) FILTER (WHERE loadable) AS loadable_begin, MAX(tx) FILTER (WHERE loadable) AS loadable_end, MIN(tx) FILTER (WHERE complete) AS complete_begin, MAX(tx) FILTER (WHERE complete) AS complete_end,
      MIN(tx) FILTER (WHERE NOT complete) AS incomplete_begin, MAX(tx) FILTER (WHERE NOT complete) AS incomplete_end, MIN(tx) FILTER (WHERE contiguous) AS contiguous_begin, MAX(tx) FILTER (WHERE contiguous) AS contiguous_end,
      MIN(tx) FILTER (WHERE NOT contiguous) AS noncontiguous_begin, MAX(tx) FILTER (WHERE NOT contiguous) AS noncontiguous_end, MIN(tx) FILTER (WHERE old) AS old_enough_begin, MAX(tx) FILTER (WHERE old) AS old_enough_end,
      COALESCE(MAX(old_missing), 0) AS missing_old_transactions, CAST(SUM(over) AS BIGINT) AS overcomplete_transactions FROM k GROUP BY server""")
def x13(t):
    """Transactions = orders per server (customer group), events = their lines; some transactions missing or incomplete."""
    k = F.col("o_orderkey")
    tr = t.orders.filter("o_totalprice <= 480000").select((F.col("o_custkey") % 20).alias("server"), k.alias("tx"), F.when(k % 50 == 0, 9).otherwise(1).alias("want"), F.col("o_orderdate").alias("created"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("tx"), "l_linenumber")
    n = tasks_for(lines.count())                             # the join and the counting after it stay in tasks of bounded size
    ev = lines.repartition(n, "tx").join(t.orders.select(k.alias("tx"), (F.col("o_custkey") % 20).alias("server")).repartition(n, "tx"), "tx")
    return X.completeness(tr, ev, "server", "tx", "want", "created", "2000-01-01 00:00:00", "l_linenumber")


@query("x14_seq_gap", """SELECT (SELECT MAX(event_id) FROM events) AS high_a, (SELECT MAX(event_id) FROM events WHERE value <= 150) AS high_b,
    (SELECT COUNT(*) FROM events WHERE value > 150) AS missing""")
def x14(t):
    """High-water marks of a log and a lossy copy, and the number of lost rows."""
    from ..operators.aggs import with_stats
    marks, lost = X.seq_gap_report(t.events.select("event_id"), t.events.filter("value <= 150").select("event_id"), "event_id")
    return with_stats(marks, lost.agg(F.count(F.lit(1)).alias("missing"))).select("high_a", "high_b", "missing")


@query("x14_seq_missing_rows", "SELECT event_id FROM events WHERE value > 150")
def x14b(t):
    return X.seq_gap_report(t.events.select("event_id"), t.events.filter("value <= 150").select("event_id"), "event_id")[1]


@query("x15_price_drop", """SELECT event_id, ROUND(p - value, 2) AS drop FROM (SELECT *, LAG(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p FROM events) WHERE value < p""")
def x15(t):
    d = X.diff_alert(t.events.select("event_id", "user_id", "event_type", "ts", "value"), ["user_id", "event_type"], ["ts", "event_id"], "value")
    return d.select("event_id", F.round("drop", 2).alias("drop"))
