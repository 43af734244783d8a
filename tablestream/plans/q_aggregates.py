"""Grouped aggregates."""

from pyspark.sql import functions as F

from ..operators import aggs as A, windows as W
from .registry import query



@query("a01_count_by_key", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def a01(t):
    return A.agg(t.events, "event_type", {"n": ("count", "*")})


@query("a02_sum_min_max_avg", """SELECT user_id, ROUND(SUM(value), 2) AS total, MIN(value) AS low, MAX(value) AS high,
    ROUND(SUM(value), 2) / COUNT(value) AS mean FROM events GROUP BY user_id""")
def a02(t):
    d = A.agg(t.events, "user_id", {"total": ("sum", "value"), "low": ("min", "value"), "high": ("max", "value"), "n": ("count", "value")})
    return d.withColumn("total", F.round("total", 2)).withColumn("mean", F.col("total") / F.col("n")).drop("n")


@query("a03_global", "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total, MAX(o_totalprice) AS top FROM orders")
def a03(t):
    return A.agg(t.orders, None, {"n": ("count", "*"), "total": ("sum", "o_totalprice"), "top": ("max", "o_totalprice")}).withColumn("total", F.round("total", 2))


@query("a04_count_distinct", "SELECT event_type, COUNT(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def a04(t):
    return A.count_distinct(t.events, "event_type", "user_id", "users")


@query("a04_count_distinct_multi", """SELECT l_returnflag, COUNT(*) AS pairs FROM
    (SELECT DISTINCT l_returnflag, l_partkey, l_suppkey FROM lineitem) GROUP BY l_returnflag""")
def a04b(t):
    return A.count_distinct(t.lineitem, "l_returnflag", ["l_partkey", "l_suppkey"], "pairs")


@query("a05_conditional", """SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'error') AS errors,
    ROUND(SUM(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS spent FROM events GROUP BY user_id""")
def a05(t):
    d = A.agg(t.events, "user_id", {"errors": ("count_if", "event_type = 'error'"), "spent": ("sum", "case when event_type = 'purchase' then value else 0 end")})
    return d.withColumn("spent", F.round("spent", 2))


@query("a06_rate", """SELECT o_orderpriority, ROUND(COUNT(*) FILTER (WHERE o_orderstatus = 'F') * 100.0::DOUBLE / COUNT(*), 6) AS pct_done
    FROM orders GROUP BY o_orderpriority""")
def a06(t):
    return A.rate(t.orders, "o_orderpriority", F.col("o_orderstatus") == "F", "pct_done", digits=6)


@query("a07_array_agg", """SELECT l_orderkey, array_to_string(list_sort(list(l_partkey)), ',') AS parts FROM lineitem GROUP BY l_orderkey""")
def a07(t):
    """Parts of each order; an order has a handful of lines, so no group grows with the data."""
    d = A.collect(t.lineitem, "l_orderkey", "l_partkey", "parts")
    return d.withColumn("parts", F.array_join(F.col("parts").cast("array<string>"), ","))


@query("a08_array_agg_distinct", """SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id""")
def a08(t):
    return A.collect(t.events, "user_id", "event_type", "kinds", distinct=True).withColumn("kinds", F.array_join("kinds", ","))


@query("a09_array_agg_rows", """SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey || ':' || CAST(l_quantity AS INTEGER), ',' ORDER BY l_linenumber, l_partkey, l_quantity) AS lines
    FROM lineitem GROUP BY l_orderkey""")
def a09(t):
    """Rows with a nested row per line, gathered per order."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.struct(F.col("l_quantity").cast("int").alias("q"), "l_returnflag").alias("detail"))
    d = A.collect_rows(li, "l_orderkey", ["l_linenumber", "l_partkey", "detail"], "items")
    text = F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["l_partkey"], x["detail"]["q"]))
    return d.select("l_orderkey", F.array_join(text, ",").alias("lines"))


@query("a10_multiset", """WITH c AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY ALL)
    SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS bag FROM c GROUP BY user_id""")
def a10(t):
    d = A.collect_multiset(t.events, "user_id", "event_type", "items")
    return d.select("user_id", F.array_join(F.transform("items", lambda x: F.concat_ws("=", x["value"], x["count"])), ",").alias("bag"))


@query("a11_listagg", """SELECT l_orderkey, string_agg(l_returnflag, '|' ORDER BY l_linenumber, l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey""")
def a11(t):
    return A.listagg(t.lineitem, "l_orderkey", "l_returnflag", "|", "l_linenumber", "flags")


@query("a12_latest_value", """WITH e AS (SELECT user_id, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS state FROM events)
    SELECT user_id, arg_max_null(state, ts) AS state, arg_max(state, ts) FILTER (WHERE state IS NOT NULL) AS last_known FROM e GROUP BY user_id""")
def a12(t):
    """Value at the latest time (NULL stays NULL) next to the latest non-null value."""
    e = t.events.select("user_id", "ts", F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("state"))
    return e.groupBy("user_id").agg(F.max_by("state", "ts").alias("state"),
                                    F.max_by("state", F.when(F.col("state").isNotNull(), F.col("ts"))).alias("last_known"))


@query("a13_max_record", """SELECT user_id, event_id, event_type, value FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def a13(t):
    return A.max_rec(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", ["value", "event_id"])


@query("a13_min_record", """SELECT user_id, event_id, event_type, value FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn FROM events) WHERE rn = 1""")
def a13b(t):
    return A.min_rec(t.events.select("user_id", "event_id", "event_type", "value"), "user_id", ["value", "event_id"])


@query("a14_avg_by_key", """SELECT date_trunc('month', o_orderdate) AS month, ROUND(SUM(o_totalprice), 2) AS total, COUNT(o_totalprice) AS n,
    ROUND(SUM(o_totalprice), 2) / COUNT(o_totalprice) AS avg_price FROM orders GROUP BY 1""")
def a14(t):
    o = t.orders.select(F.make_timestamp_ntz(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("month"), "o_totalprice")
    d = A.avg_by(o, "month", "o_totalprice")
    return d.select("month", F.round("total", 2).alias("total"), "n", (F.round("total", 2) / F.col("n")).alias("avg_price"))


@query("a15_argmax_group", """SELECT l_suppkey, SUM(l_quantity) AS total FROM lineitem GROUP BY l_suppkey ORDER BY total DESC, l_suppkey LIMIT 1""")
def a15(t):
    return A.argmax_group(t.lineitem, "l_suppkey", "l_quantity")


@query("a16_word_count", r"""SELECT word, COUNT(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word""")
def a16(t):
    """Word counts over all texts."""
    return A.word_count(t.documents, "text", "[^a-z]+")


@query("a17_fraud_total", "SELECT COUNT(*) AS total_flagged FROM orders WHERE o_totalprice > 450000")
def a17a(t):
    return A.agg(t.orders.filter("o_totalprice > 450000"), None, {"total_flagged": ("count", "*")})


@query("a17_fraud_by_type", "SELECT o_orderpriority, COUNT(*) AS flagged FROM orders WHERE o_totalprice > 450000 GROUP BY o_orderpriority")
def a17b(t):
    return A.agg(t.orders.filter("o_totalprice > 450000"), "o_orderpriority", {"flagged": ("count", "*")})


@query("a17_fraud_rate_by_status", """SELECT o_orderstatus, COUNT(*) AS total_applications, COUNT(*) FILTER (WHERE o_totalprice > 450000) AS flagged,
    ROUND(COUNT(*) FILTER (WHERE o_totalprice > 450000)::DOUBLE / COUNT(*) * 100, 6) AS rate_percent FROM orders GROUP BY o_orderstatus""")
def a17c(t):
    d = A.agg(t.orders, "o_orderstatus", {"total_applications": ("count", "*"), "flagged": ("count_if", "o_totalprice > 450000")})
    return d.withColumn("rate_percent", F.round(F.col("flagged") / F.col("total_applications") * 100, 6))


@query("a17_fraud_amounts", """SELECT CASE WHEN o_totalprice > 450000 THEN 'Flagged' ELSE 'Normal' END AS kind, COUNT(*) AS n,
    ROUND(SUM(o_totalprice), 2) / COUNT(*) AS avg_amount FROM orders GROUP BY 1""")
def a17d(t):
    d = t.orders.withColumn("kind", F.when(F.col("o_totalprice") > 450000, "Flagged").otherwise("Normal"))
    return d.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("avg_amount"))


@query("a18_key_stats", """WITH k AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id)
    SELECT ROUND(AVG(n), 6) AS mean_count, ROUND(STDDEV(n), 6) AS stddev_count, QUANTILE_CONT(n, 0.75) AS q3, ROUND(QUANTILE_CONT(n, 0.95), 6) AS p95,
    ROUND(QUANTILE_CONT(n, 0.99), 6) AS p99 FROM k""")
def a18(t):
    s = A.key_stats(A.agg(t.events, "user_id", {"n": ("count", "*")}), "n")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


@query("a18_exact_quantile", "SELECT event_type, ROUND(QUANTILE_CONT(value, 0.5), 4) AS median, ROUND(QUANTILE_CONT(value, 0.9), 4) AS p90 FROM events GROUP BY event_type")
def a18b(t):
    """Exact quantiles of a column per key, for keys of any size."""
    a = A.exact_quantile(t.events, "event_type", "value", 0.5, "median")
    b = A.exact_quantile(t.events, "event_type", "value", 0.9, "p90")
    return a.join(b, "event_type").select("event_type", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@query("a19_hot_keys", """WITH k AS (SELECT user_id, COUNT(*) AS record_count FROM events GROUP BY user_id),
    d AS (SELECT AVG(record_count) AS mean_count, STDDEV(record_count) AS sd, QUANTILE_CONT(record_count, 0.75) AS q3,
          QUANTILE_CONT(record_count, 0.95) AS p95, QUANTILE_CONT(record_count, 0.99) AS p99 FROM k)
    SELECT user_id, record_count, ROUND(CASE WHEN sd > 0 THEN (record_count - mean_count) / sd ELSE 0 END, 5) AS z_score,
      CASE WHEN record_count > p99 THEN 'EXTREME_HOT' WHEN record_count > p95 THEN 'VERY_HOT' WHEN record_count > q3 * 1.5 THEN 'HOT' ELSE 'NORMAL' END AS hot_key_category
    FROM k, d WHERE record_count > mean_count""")
def a19(t):
    return A.hot_keys(t.events, "user_id").select("user_id", "record_count", F.round("z_score", 5).alias("z_score"), "hot_key_category")


@query("a20_upsert_sum", "SELECT user_id, event_type, ROUND(SUM(value), 2) AS total FROM events GROUP BY ALL")
def a20(t):
    return A.agg(t.events, ["user_id", "event_type"], {"total": ("sum", "value")}).withColumn("total", F.round("total", 2))


@query("a21_dedup_then_agg", """WITH log AS (SELECT o_orderkey % 5000 AS k, * FROM orders),
    d AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM log) WHERE rn = 1)
    SELECT o_orderpriority, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM d GROUP BY o_orderpriority""")
def a21(t):
    log = t.orders.withColumn("k", F.col("o_orderkey") % 5000)
    d = A.dedup_then_agg(log, "k", ["o_orderdate", "o_orderkey"], "o_orderpriority", {"n": ("count", "*"), "total": ("sum", "o_totalprice")})
    return d.withColumn("total", F.round("total", 2))


@query("a22_rollup_totals", """SELECT user_id, ROUND(SUM(tt), 2) AS total, COUNT(*) AS n_parts FROM
    (SELECT user_id, event_type, SUM(value) AS tt FROM events GROUP BY ALL) GROUP BY user_id""")
def a22(t):
    return A.rollup_totals(t.events, ["user_id", "event_type"], "user_id", "value").withColumn("total", F.round("total", 2))


@query("a23_dedup_stats", """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT text) AS unique_rows, COUNT(*) - COUNT(DISTINCT text) AS removed_rows,
    ROUND((COUNT(*) - COUNT(DISTINCT text)) * 100.0::DOUBLE / COUNT(*), 2) AS removed_pct FROM documents""")
def a23(t):
    """Effect of deduplicating the documents by whole text (grouped by digest)."""
    return A.dedup_stats(t.documents.select(F.sha2("text", 256).alias("h")), "h")


@query("a24_recency", """SELECT user_id, COUNT(*) FILTER (WHERE DATE '2024-01-31' - CAST(ts AS DATE) BETWEEN 0 AND 7) AS last_7_days,
    COUNT(*) FILTER (WHERE DATE '2024-01-31' - CAST(ts AS DATE) BETWEEN 0 AND 14) AS last_14_days FROM events GROUP BY user_id""")
def a24(t):
    return A.recency_counts(t.events, "user_id", "ts", "2024-01-31", (7, 14))


@query("a25_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def a25(t):
    return t.events.select("user_id", "event_type").distinct()


@query("a26_two_phase", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total, MAX(value) AS top FROM events GROUP BY event_type")
def a26(t):
    d = A.agg_two_phase(t.events, "event_type", {"n": ("count", "*"), "total": ("sum", "value"), "top": ("max", "value")}, "event_id", 16)
    return d.withColumn("total", F.round("total", 2))


@query("a27_window_max_of_sums", """WITH s AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, user_id, ROUND(SUM(value), 2) AS total FROM events GROUP BY ALL)
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, user_id, total FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY total DESC, user_id) AS rn FROM s) WHERE rn = 1""")
def a27(t):
    return W.window_max_of_sums(t.events, "ts", "1 hour", "user_id", "value")
