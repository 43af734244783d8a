"""Projection, filter, set operations."""

from pyspark.sql import functions as F

from ..operators import relational as R
from .registry import query


@query("p01_select_rename", "SELECT event_id AS id, user_id AS who, value AS amount FROM events")
def p01(t):
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("who"), F.col("value").alias("amount"))


@query("p02_with_cols", """SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderpriority,
    ROUND(o_totalprice * 2, 2) AS double_price FROM orders""")
def p02(t):
    return R.with_cols(t.orders, add={"double_price": F.round(F.col("o_totalprice") * 2, 2)},
                       rename={"o_totalprice": "price"}, drop=["o_orderstatus", "o_orderdate"])


@query("p03_filter", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity >= 45 AND l_discount < 0.03 AND l_returnflag = 'R'""")
def p03(t):
    return t.lineitem.filter("l_quantity >= 45 and l_discount < 0.03 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@query("p04_like_any", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%widget%' OR p_name LIKE 'red%' OR p_name LIKE '%r_ng'")
def p04(t):
    return t.part.filter(R.like_any("p_name", ["%widget%", "red%", "%r_ng"])).select("p_partkey", "p_name")


@query("p05_in_list", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def p05(t):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("p06_regex", "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '#0+[0-9]*7$') AND NOT regexp_matches(c_name, '77')")
def p06(t):
    return t.customer.filter(F.col("c_name").rlike("#0+[0-9]*7$") & ~F.col("c_name").rlike("77")).select("c_custkey", "c_name")


@query("p07_between", "SELECT event_id, value FROM events WHERE value BETWEEN 10.0 AND 12.5")
def p07(t):
    return t.events.filter(F.col("value").between(10.0, 12.5)).select("event_id", "value")


@query("p08_null_safe", """WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS a,
      CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS b FROM events)
    SELECT event_id, a IS NULL AS a_missing, a IS NOT DISTINCT FROM b AS same FROM e""")
def p08(t):
    blank = lambda n: F.when(F.col("event_id") % n != 0, F.col("event_type"))
    e = t.events.select("event_id", blank(7).alias("a"), blank(5).alias("b"))
    return e.select("event_id", F.col("a").isNull().alias("a_missing"), F.col("a").eqNullSafe(F.col("b")).alias("same"))


@query("p09_classify", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'HIGH' WHEN o_totalprice > 150000 THEN 'MEDIUM'
      WHEN o_orderstatus = 'F' THEN 'LOW_DONE' ELSE 'LOW' END AS price_class FROM orders""")
def p09(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", R.classify([(p > 400000, "HIGH"), (p > 150000, "MEDIUM"), (F.col("o_orderstatus") == "F", "LOW_DONE")], "LOW").alias("price_class"))


@query("p10_having", """SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders
    GROUP BY o_custkey HAVING COUNT(*) > 12""")
def p10(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).filter("n > 12")


@query("p11_map_rows", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, user_id + 1 AS next_user FROM events WHERE user_id >= 18")
def p11(t):
    return t.events.filter("user_id >= 18").select("event_id", F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("parity"),
                                                    (F.col("user_id") + 1).alias("next_user"))


@query("p12_clean", """SELECT o_orderkey, UPPER(TRIM('  ' || o_orderpriority || ' ')) AS priority, o_orderstatus FROM orders
    WHERE o_orderstatus IN ('F', 'O')""")
def p12(t):
    d = t.orders.select("o_orderkey", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("priority"), "o_orderstatus")
    return R.clean(d, "priority", "o_orderstatus", ["F", "O"])


@query("p13_defaults", """SELECT event_id, COALESCE(CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END, -1) AS user_id,
      COALESCE(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END, 'unknown') AS event_type FROM events""")
def p13(t):
    e = t.events.select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"),
                        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"))
    return R.fill_defaults(e, {"user_id": -1, "event_type": "unknown"})


@query("p14_mask", r"SELECT doc_id, md5(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+', '****', 'g')) AS masked_md5 FROM documents")
def p14(t):
    """Mask e-mail addresses in whole texts (digest of the masked text keeps the result small)."""
    return t.documents.select("doc_id", F.md5(R.mask("text", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+")).alias("masked_md5"))


@query("p15_struct_fields", "SELECT event_id, user_id, event_type, value FROM events")
def p15(t):
    """Nested row access: pack into a row, then open it with ``row.*``."""
    nested = t.events.select("event_id", F.struct("user_id", F.struct("event_type", "value").alias("detail")).alias("r"))
    return nested.select("event_id", "r.user_id", "r.detail.*")


@query("p16_constants", "SELECT c_custkey, 'EU' AS region_code, 7 AS rule_id FROM customer")
def p16(t):
    return R.with_consts(t.customer.select("c_custkey"), {"region_code": "EU", "rule_id": 7})


@query("p17_bounding_box", """WITH g AS (SELECT event_id, (event_id % 3600) / 10.0 - 180 AS lon, (event_id % 1800) / 10.0 - 90 AS lat FROM events)
    SELECT event_id FROM g WHERE lon BETWEEN -74.3 AND -60.7 AND lat BETWEEN -20.5 AND 60.5""")
def p17(t):
    g = t.events.select("event_id", (F.col("event_id") % 3600 / 10.0 - 180).alias("lon"), (F.col("event_id") % 1800 / 10.0 - 90).alias("lat"))
    return g.filter(R.in_bbox("lon", "lat", -74.3, -60.7, -20.5, 60.5)).select("event_id")


@query("u01_union_all", """SELECT event_id, value, 'big' AS part FROM events WHERE value > 50
    UNION ALL SELECT event_id, value, 'error' AS part FROM events WHERE event_type = 'error'""")
def u01(t):
    e = t.events.select("event_id", "value", "event_type")
    return R.union_all([e.filter("value > 50").select("event_id", "value", F.lit("big").alias("part")),
                        e.filter("event_type = 'error'").select("event_id", "value", F.lit("error").alias("part"))])


@query("u02_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey AS k FROM customer")
def u02(t):
    return R.union_distinct([t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))])


@query("u03_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0")
def u03a(t):
    return R.intersect(t.orders.select(F.col("o_custkey").alias("k")), t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")))


@query("u03_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'")
def u03b(t):
    return R.except_rows(t.customer.select(F.col("c_custkey").alias("k")), t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")))


@query("u03_except_all", "SELECT user_id AS k FROM events EXCEPT ALL SELECT user_id AS k FROM events WHERE event_type = 'click'")
def u03c(t):
    e = t.events
    return R.except_rows(e.select(F.col("user_id").alias("k")), e.filter("event_type = 'click'").select(F.col("user_id").alias("k")), all_rows=True)


@query("u04_union_many", """SELECT 'customer' AS src, CAST(c_custkey AS BIGINT) AS id, c_acctbal AS bal FROM customer UNION ALL
    SELECT 'supplier' AS src, CAST(s_suppkey AS BIGINT) AS id, s_acctbal AS bal FROM supplier UNION ALL
    SELECT 'part' AS src, CAST(p_partkey AS BIGINT) AS id, p_retailprice AS bal FROM part""")
def u04(t):
    f = lambda d, s, k, v: d.select(F.lit(s).alias("src"), F.col(k).cast("bigint").alias("id"), F.col(v).alias("bal"))
    return R.union_all([f(t.customer, "customer", "c_custkey", "c_acctbal"), f(t.supplier, "supplier", "s_suppkey", "s_acctbal"),
                        f(t.part, "part", "p_partkey", "p_retailprice")])


@query("u05_count_compare", """SELECT 'raw' AS label, COUNT(*) AS n FROM events UNION ALL
    SELECT 'dedup' AS label, COUNT(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)""")
def u05(t):
    return R.count_compare({"raw": t.events, "dedup": t.events.select("user_id", "event_type").distinct()})


@query("u06_cutover", """SELECT event_id, ts, value AS score FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' UNION ALL
    SELECT event_id, ts, ROUND(value * 2, 2) AS score FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'""")
def u06(t):
    e = t.events
    return R.cutover(e.select("event_id", "ts", F.col("value").alias("score")),
                     e.select("event_id", "ts", F.round(F.col("value") * 2, 2).alias("score")), "ts",
                     F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
