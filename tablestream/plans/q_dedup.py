"""Deduplication, top-N."""

from pyspark.sql import functions as F

from ..operators import dedup as D
from .registry import query


@query("t01_dedup_last", "SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def t01(t):
    return D.dedup_last(t.events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("t02_dedup_first", "SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def t02(t):
    return D.dedup_first(t.events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("t03_dedup_content", "SELECT MAX(doc_id) AS doc_id FROM documents GROUP BY text, lang")
def t03(t):
    """Newest document of each (whole text, language)."""
    return D.dedup_content(t.documents.select("doc_id", "text", "lang"), ["text", "lang"], "doc_id").select("doc_id")


@query("t04_two_level", """WITH a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS r1 FROM orders),
    b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r2 FROM a WHERE r1 = 1) SELECT o_custkey, o_orderkey, o_totalprice FROM b WHERE r2 = 1""")
def t04(t):
    return D.dedup_two_level(t.orders, ["o_custkey", "o_orderdate"], "o_orderkey", "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice")


@query("t05_first_per_value", """SELECT user_id, event_type, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def t05(t):
    return D.first_per_value(t.events, "user_id", "event_type", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("t06_priority", """SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END, ts DESC) AS rn FROM events) WHERE rn = 1""")
def t06(t):
    pr = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    return D.dedup_priority(t.events, "user_id", pr, "ts").select("user_id", "event_id", "event_type")


@query("t07_top_n", """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(rn AS INTEGER) AS rank FROM
    (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn FROM lineitem) WHERE rn <= 3""")
def t07(t):
    d = D.top_n(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), "l_suppkey", ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"], 3, rank="rank")
    return d


@query("t08_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25")
def t08(t):
    return D.order_limit(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 25)


@query("t09_dedup_after_fan_out", """SELECT 'big' AS sink, user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE value > 20) WHERE rn = 1
    UNION ALL SELECT 'error' AS sink, user_id, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE event_type = 'error') WHERE rn = 1""")
def t09(t):
    from ..operators.relational import route, union_all
    sinks = route(t.events, {"big": F.col("value") > 20, "error": F.col("event_type") == "error"})
    return union_all([d.select(F.lit(n).alias("sink"), "user_id", "event_id") for n, d in D.dedup_after(sinks, "user_id", "ts").items()])


@query("t10_latest_then_collect", """WITH v AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM
      (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)
    SELECT o_custkey, string_agg(o_orderpriority || '/' || o_orderkey, ',' ORDER BY o_orderpriority) AS history FROM v GROUP BY o_custkey""")
def t10(t):
    """Latest order per (customer, priority): at most five entries per customer."""
    d = D.latest_then_collect(t.orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_custkey", ["o_orderpriority", "o_orderkey"])
    return d.select("o_custkey", F.array_join(F.transform("items", lambda x: F.concat_ws("/", x["o_orderpriority"], x["o_orderkey"])), ",").alias("history"))
