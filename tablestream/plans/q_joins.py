"""Equi, outer, interval, as-of, lookup, salted joins."""

from pyspark.sql import functions as F

from ..operators import joins as J, nested as NE, temporal as T
from ..operators.core import interval
from .registry import query


def views(t):
    """Versioned side: one version per view event."""
    return t.events.filter("event_type = 'view'").select("user_id", F.col("ts").alias("v_ts"), F.col("value").alias("rate"))


def purchases(t):
    return t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


@query("j01_inner", """SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def j01(t):
    c = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), "c_name")
    return J.join_inner(t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice"), c, "k").drop("k")


@query("j02_left", """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def j02(t):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.join_left(t.customer.select("c_custkey"), o, "c_custkey")


@query("j03_right", """SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey""")
def j03(t):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.join_right(o, t.customer.select("c_custkey"), "c_custkey")


@query("j04_full", """SELECT COALESCE(a.k, b.k) AS k, COALESCE(a.name, 'NULL') AS name, COALESCE(b.pri, 'NULL') AS pri FROM
    (SELECT c_custkey AS k, c_name AS name FROM customer) a FULL JOIN
    (SELECT o_custkey AS k, MAX(o_orderpriority) AS pri FROM orders GROUP BY o_custkey) b ON a.k = b.k""")
def j04(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    b = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("pri"))
    return J.join_full(a, b, "k", fill="NULL")


@query("j05_cross_stats", """SELECT event_id, value, ROUND(value / (SELECT ROUND(SUM(value), 2) / COUNT(*) FROM events), 6) AS ratio FROM events""")
def j05(t):
    """Every row next to global statistics (scalar subquery)."""
    d = J.cross_stats(t.events.select("event_id", "value"), {"s": F.round(F.sum("value"), 2), "n": F.count(F.lit(1))})
    return d.select("event_id", "value", F.round(F.col("value") / (F.col("s") / F.col("n")), 6).alias("ratio"))


def org(t):
    """A hierarchy from the tables: region -> nation -> supplier ('PERSON' leaves)."""
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    up = t.nation.join(r, "n_regionkey").select(F.col("r_name").alias("group_name"), F.col("n_name").alias("item_name"), F.lit("GROUP").alias("item_type"))
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return up.unionByName(s.select(F.col("n_name").alias("group_name"), F.col("s_name").alias("item_name"), F.lit("PERSON").alias("item_type")))


ORG_SQL = """WITH RECURSIVE g AS (SELECT r_name AS group_name, n_name AS item_name, 'GROUP' AS item_type FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT n_name AS group_name, s_name AS item_name, 'PERSON' AS item_type FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


@query("j06_hierarchy_two_levels", ORG_SQL + """ SELECT group_name, item_name FROM g WHERE item_type = 'PERSON'
    UNION ALL SELECT p.group_name, c.item_name FROM g p JOIN g c ON p.item_name = c.group_name WHERE p.item_type = 'GROUP' AND c.item_type = 'PERSON'""")
def j06(t):
    return J.expand_hierarchy(org(t), "group_name", "item_name", "item_type", depth=2)


@query("j07_hierarchy_any_depth", """WITH RECURSIVE g AS (SELECT DISTINCT 'g' || (o_custkey // 2) AS p, 'g' || o_custkey AS c, true AS is_group FROM orders WHERE o_custkey > 0
      UNION SELECT DISTINCT 'g' || o_custkey AS p, 'o' || o_orderkey AS c, false AS is_group FROM orders),
    r AS (SELECT p AS root, c, is_group FROM g UNION SELECT r.root, g.c, g.is_group FROM r JOIN g ON r.c = g.p WHERE r.is_group)
    SELECT root, COUNT(*) AS members FROM r WHERE NOT is_group GROUP BY root""")
def j07(t):
    """Customers as a binary tree of groups (parent = half the key) with their orders as leaves: members below each group."""
    k = F.col("o_custkey")
    name = lambda c: F.concat(F.lit("g"), c.cast("string"))
    up = t.orders.filter(k > 0).select(name(F.floor(k / 2)).alias("p"), name(k).alias("c"), F.lit("GROUP").alias("kind"))
    leaf = t.orders.select(name(k).alias("p"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("c"), F.lit("LEAF").alias("kind"))
    return J.expand_hierarchy(up.unionByName(leaf), "p", "c", "kind", depth=None).groupBy(F.col("p").alias("root")).agg(F.count(F.lit(1)).alias("members"))


@query("j08_or_condition", """SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_suppkey = c_custkey OR s_acctbal = c_acctbal
    OR (s_nationkey = c_nationkey AND FLOOR(s_acctbal / 10) = FLOOR(c_acctbal / 10))""")
def j08(t):
    l, r = t.supplier.alias("l"), t.customer.alias("r")
    conds = [F.col("l.s_suppkey") == F.col("r.c_custkey"), F.col("l.s_acctbal") == F.col("r.c_acctbal"),
             (F.col("l.s_nationkey") == F.col("r.c_nationkey")) & (F.floor(F.col("l.s_acctbal") / 10) == F.floor(F.col("r.c_acctbal") / 10))]
    return J.join_any(l, r, conds).select("s_suppkey", "c_custkey")


@query("j09_range", """WITH tr AS (SELECT DISTINCT time_bucket(INTERVAL '1 day', ts) + INTERVAL '11 hours 30 minutes' AS cutoff_ts FROM events)
    SELECT cutoff_ts, event_id FROM tr JOIN events ON ts >= cutoff_ts - INTERVAL '2 hours' AND ts <= cutoff_ts""")
def j09(t):
    """Events in the two hours before each daily cutoff: a range join without key."""
    tr = t.events.select((F.col("ts").cast("date").cast("timestamp_ntz") + interval(11.5 * 3600)).alias("cutoff_ts")).distinct()
    return T.join_range(tr, t.events.select("event_id", "ts"), "cutoff_ts", "ts", "-2 hours", 0).select("cutoff_ts", "event_id")


INTERVAL_SQL = "v.user_id = p.user_id AND v.ts BETWEEN p.ts - INTERVAL '1 day' AND p.ts + INTERVAL '2 hours'"


@query("j10_interval", f"""SELECT p.event_id, v.ts AS v_ts, v.value AS rate FROM events p JOIN events v ON {INTERVAL_SQL}
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def j10(t):
    return T.join_interval(purchases(t), views(t), "user_id", "ts", "v_ts", "-1 day", "2 hours").select("event_id", "v_ts", "rate")


@query("j10_interval_left", f"""SELECT p.event_id, v.ts AS v_ts FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON {INTERVAL_SQL}""")
def j10b(t):
    return T.join_interval(purchases(t), views(t), "user_id", "ts", "v_ts", "-1 day", "2 hours", "left").select("event_id", "v_ts")


ASOF_SQL = """SELECT p.event_id, p.ts, v.ts AS v_ts, v.value AS rate FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts"""


@query("j11_asof", ASOF_SQL)
def j11(t):
    return T.join_asof(purchases(t), views(t), "user_id", "ts", "v_ts").select("event_id", "ts", "v_ts", "rate")


@query("j11_asof_inner", """SELECT p.event_id, v.value AS rate, CAST(CAST(p.value AS DECIMAL(9,2)) * CAST(v.value AS DECIMAL(9,2)) AS DOUBLE) AS converted FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def j11b(t):
    d = T.join_asof(purchases(t), views(t), "user_id", "ts", "v_ts", "inner")
    exact = F.col("value").cast("decimal(10,2)") * F.col("rate").cast("decimal(10,2)")
    return d.select("event_id", "rate", exact.cast("double").alias("converted"))


@query("j11_versions", """SELECT user_id, event_id, ts AS valid_from, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events WHERE event_type = 'view'""")
def j11c(t):
    v = T.versions(t.events.filter("event_type = 'view'").select("user_id", "event_id", "ts"), "user_id", "ts")
    return v.select("user_id", "event_id", "valid_from", "valid_to")


@query("j12_rules", """WITH r AS (SELECT user_id, user_id % 3 AS grp, ts AS r_ts, value AS threshold FROM events WHERE event_type = 'signup'),
    e AS (SELECT event_id, user_id, user_id % 3 AS grp, ts, value FROM events WHERE event_type = 'error')
    SELECT e.event_id, r.threshold FROM e ASOF JOIN r ON e.user_id = r.user_id AND e.grp = r.grp AND e.ts >= r.r_ts WHERE e.value > r.threshold""")
def j12(t):
    """Rule version valid at event time by a two-column key, kept when the threshold is broken."""
    grp = (F.col("user_id") % 3).alias("grp")
    rules = t.events.filter("event_type = 'signup'").select("user_id", grp, F.col("ts").alias("r_ts"), F.col("value").alias("threshold"))
    e = t.events.filter("event_type = 'error'").select("event_id", "user_id", grp, "ts", "value")
    return T.join_rules(e, rules, ["user_id", "grp"], "ts", "r_ts", F.col("value") > F.col("threshold")).select("event_id", "threshold")


@query("j13_asof_many", """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    a AS (SELECT p.*, v.value AS rate FROM p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts)
    SELECT a.event_id, a.rate, s.event_id AS signup_id FROM a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON a.user_id = s.user_id AND a.ts >= s.ts""")
def j13(t):
    s = t.events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("s_ts"), F.col("event_id").alias("signup_id"))
    return T.enrich_asof_many(purchases(t), "ts", [(views(t), "user_id", "v_ts"), (s, "user_id", "s_ts")]).select("event_id", "rate", "signup_id")


@query("j14_ttl", """SELECT p.event_id, v.ts AS v_ts FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL '3 hours' AND p.ts + INTERVAL '1 hour'
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def j14(t):
    return T.join_ttl(purchases(t), views(t), "user_id", "ts", "v_ts", "1 hour", "3 hours").select("event_id", "v_ts")


@query("j15_upsert_join", """WITH f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1),
    d AS (SELECT o_custkey AS user_id, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price FROM orders GROUP BY o_custkey)
    SELECT f.event_id, f.user_id, d.price FROM f LEFT JOIN d ON f.user_id = d.user_id""")
def j15(t):
    dim = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("price"), "o_orderdate", "o_orderkey")
    f = t.events.select("event_id", "user_id", "event_type", "ts")
    return J.join_upsert(f, ["user_id", "event_type"], "ts", dim, "user_id", ["o_orderdate", "o_orderkey"], "user_id").select("event_id", "user_id", "price")


@query("j16_lookup", """SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS lookup_status, c_name FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def j16(t):
    dim = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    ok, failed = J.join_lookup(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey")
    return ok.unionByName(failed).select("o_orderkey", "lookup_status", "c_name")


@query("j18_key_search", """SELECT o_orderkey, COUNT(l_linenumber) AS n, string_agg(l_partkey || '', ',' ORDER BY l_partkey) AS parts FROM orders
    LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def j18(t):
    """Each order with the array of its lines, empty when it has none."""
    li = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    d = J.key_search(t.orders.select("o_orderkey"), li, "o_orderkey", "l_partkey")
    parts = F.array_join(F.transform("matches", lambda m: m["l_partkey"].cast("string")), ",")
    return d.select("o_orderkey", F.size("matches").cast("bigint").alias("n"), F.when(F.size("matches") > 0, parts).alias("parts"))


@query("j19_lateral", r"""SELECT p_partkey, word, CAST(length(word) AS INTEGER) AS length FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word <> ''""")
def j19(t):
    from ..functions.udfs import split_words
    return J.join_lateral(t.part.select("p_partkey", "p_name"), split_words("p_name"), ["word", "length"]).select("p_partkey", "word", "length")


@query("j20_unnest", "SELECT vec_id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings")
def j20(t):
    return NE.unnest(t.embeddings.select("vec_id", "embedding"), "embedding", "x", position="pos").select("vec_id", "pos", F.col("x").cast("double").alias("x"))


@query("j21_multi_way", """SELECT n_name, o_orderpriority, COUNT(*) AS lines, SUM(l_quantity) AS qty FROM customer JOIN orders ON c_custkey = o_custkey
    JOIN lineitem ON o_orderkey = l_orderkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def j21(t):
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    j = J.join_many([(o, "l_orderkey"), (c, "c_custkey"), (t.nation.select("n_nationkey", "n_name"), "n_nationkey")], t.lineitem.select("l_orderkey", "l_quantity"))
    return j.groupBy("n_name", "o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty"))


@query("j22_join_latest", """WITH a AS (SELECT user_id, arg_max(event_id, ts) AS last_view FROM events WHERE event_type = 'view' GROUP BY user_id),
    b AS (SELECT user_id, arg_max(event_id, ts) AS last_error FROM events WHERE event_type = 'error' GROUP BY user_id)
    SELECT user_id, last_view, last_error FROM a JOIN b USING (user_id)""")
def j22(t):
    f = lambda kind, name: t.events.filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name), F.col("ts").alias(f"{name}_ts"))
    return J.join_latest(f("view", "last_view"), "user_id", "last_view_ts", f("error", "last_error"), "user_id", "last_error_ts", "user_id").select("user_id", "last_view", "last_error")


@query("j23_salted", """WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k FROM events)
    SELECT event_id, k, c_name FROM e JOIN customer ON k = c_custkey""")
def j23(t):
    """A key that holds a third of the events joined with salts."""
    e = t.events.select("event_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("k"))
    return J.join_salted(e, t.customer.select(F.col("c_custkey").alias("k"), "c_name"), "k", n=8, share=100)


@query("j25_group_tombstone", """WITH r AS (SELECT 'g' || user_id AS group_uid, CASE WHEN event_type = 'signup' THEN '' ELSE 'm' || event_id END AS group_member, ts,
      event_type = 'signup' AND event_id % 2 = 0 AS is_deleted FROM events),
    tomb AS (SELECT group_uid, MAX(ts) AS tomb FROM r WHERE group_member = '' AND is_deleted GROUP BY group_uid)
    SELECT r.group_uid, group_member, ts, CASE WHEN tomb IS NOT NULL AND ts < tomb THEN true ELSE is_deleted END AS is_deleted FROM r LEFT JOIN tomb USING (group_uid) WHERE group_member <> ''""")
def j25(t):
    signup = F.col("event_type") == "signup"
    r = t.events.select(F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("group_uid"),
                        F.when(signup, "").otherwise(F.concat(F.lit("m"), F.col("event_id").cast("string"))).alias("group_member"), "ts",
                        (signup & (F.col("event_id") % 2 == 0)).alias("is_deleted"))
    return J.apply_group_tombstone(r, "group_uid", "group_member", "ts", "is_deleted")


@query("j26_pair_once", """WITH a AS (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events WHERE event_type = 'view'),
    b AS (SELECT user_id, event_id AS purchase_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM events WHERE event_type = 'purchase')
    SELECT a.user_id, a.event_id, purchase_id FROM a JOIN b USING (user_id, n)""")
def j26(t):
    v = t.events.filter("event_type = 'view'").select("user_id", "event_id", "ts")
    p = t.events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), "ts")
    return J.pair_once(v, p, "user_id", "ts").select("user_id", "event_id", "purchase_id")


@query("j27_match_rules", """SELECT event_id, user_id, c_acctbal FROM events JOIN (SELECT * FROM customer WHERE c_acctbal < -900) ON user_id = c_custkey""")
def j27(t):
    """Events of blacklisted customers; the list is broadcast when its measured size allows."""
    black = t.customer.filter("c_acctbal < -900").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    return J.match_broadcast(t.events.select("event_id", "user_id"), black, "user_id")


@query("j28_build_fact", """WITH d AS (SELECT user_id, MAX(ts) AS d_ts, COUNT(*) AS signups FROM events WHERE event_type = 'signup' GROUP BY user_id)
    SELECT event_id, signups, GREATEST(ts, COALESCE(d_ts, ts)) AS updated_at FROM events LEFT JOIN d USING (user_id) WHERE event_type = 'purchase'""")
def j28(t):
    d = t.events.filter("event_type = 'signup'").groupBy("user_id").agg(F.max("ts").alias("d_ts"), F.count(F.lit(1)).alias("signups"))
    return J.build_fact(purchases(t), d, "user_id", "ts", "d_ts").select("event_id", "signups", "updated_at")


@query("j29_lead_time", """SELECT p.event_id, v.event_id AS view_id, CAST(trunc(epoch(p.ts - v.ts) / 3600) AS BIGINT) AS lead_hours FROM events p JOIN events v
    ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL '1 day' AND p.ts WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def j29(t):
    v = t.events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("v_ts"))
    d = T.join_interval(purchases(t), v, "user_id", "ts", "v_ts", "-1 day", 0)
    return d.select("event_id", "view_id", T.lead_time("v_ts", "ts", "HOUR").alias("lead_hours"))


@query("j30_cross_tab", "SELECT p_type, o_orderpriority, COUNT(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL")
def j30(t):
    from ..operators.aggs import cross_tab
    j = J.join_many([(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey"),
                     (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")], t.lineitem.select("l_partkey", "l_orderkey"))
    return cross_tab(j, "p_type", "o_orderpriority")


@query("j32_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j32(t):
    return J.join_anti(t.customer.select("c_custkey", "c_name"), t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
