"""Nested data."""

from pyspark.sql import functions as F

from ..operators import cdc as C, nested as NE, relational as R
from .registry import query


def account_events(t):
    kind = F.col("event_type")
    return NE.to_union(t.events, "event_type", {
        "purchase": F.struct(F.col("value").alias("amount"), "user_id"),
        "view": F.struct(F.get_json_object("props", "$.k").cast("int").alias("page")),
        "error": F.struct(F.concat(F.lit("E"), (F.col("event_id") % 10).cast("string")).alias("code"))}).select("event_id", kind, "detail")


@query("c16_to_union", """SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS amount, CASE WHEN event_type = 'view' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS page,
    CASE WHEN event_type = 'error' THEN 'E' || (event_id % 10) END AS code FROM events""")
def c16(t):
    """Multi-type events as a tagged union with one filled branch."""
    return account_events(t).select("event_id", "detail.purchase.amount", "detail.view.page", "detail.error.code")


@query("c17_split_union", """SELECT event_id, 'purchase' AS branch, CAST(value AS VARCHAR) AS payload FROM events WHERE event_type = 'purchase' UNION ALL
    SELECT event_id, 'view' AS branch, json_extract_string(props, '$.k') AS payload FROM events WHERE event_type = 'view' UNION ALL
    SELECT event_id, 'error' AS branch, 'E' || (event_id % 10) AS payload FROM events WHERE event_type = 'error'""")
def c17(t):
    parts = NE.split_union(account_events(t), "detail")
    first = {"purchase": "amount", "view": "page", "error": "code"}
    return R.union_all([d.select("event_id", F.lit(b).alias("branch"), F.col(first[b]).cast("string").alias("payload")) for b, d in parts.items()])


@query("c18_nest_children", """SELECT o_orderkey, CAST(COUNT(l_linenumber) AS INTEGER) AS n_items, CAST(COALESCE(SUM(l_quantity), 0) AS BIGINT) AS qty FROM orders
    LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def c18(t):
    """Orders as documents with their lines nested, [] when there is none."""
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"))
    d = NE.nest_children(t.orders.select("o_orderkey", "o_custkey"), li, "o_orderkey", ["l_linenumber", "qty"], "items")
    total = F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x["qty"])
    return d.select("o_orderkey", F.size("items").alias("n_items"), total.alias("qty"))


@query("c19_json_to_dim", """SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, CAST(c_nationkey AS INTEGER) AS nation, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def c19(t):
    """Customer JSON messages to a dimension with a nested address row; delete messages are skipped."""
    op = F.when(F.col("c_mktsegment") == "FURNITURE", "DELETE").otherwise("UPDATE")
    doc = F.to_json(F.struct(F.struct(op.alias("op")).alias("headers"),
                             F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).alias("data")))
    d = C.json_to_dim(t.customer.select(doc.alias("msg")), "msg", {"id": ("$.data.id", "bigint"), "name": ("$.data.name", "string")},
                      {"address": {"nation": ("$.data.nation", "int"), "segment": ("$.data.segment", "string")}})
    return d.select("id", "name", "address.nation", "address.segment")


@query("c20_flatten_states", "SELECT user_id AS key, event_type AS callsign, make_timestamp(epoch_us(date_trunc('second', ts))) AS at, value AS speed FROM events")
def c20(t):
    """Array-of-arrays payload (all values text, places count from 1) to typed rows."""
    row = F.array(F.concat(F.lit(" "), "event_type", F.lit(" ")), F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).cast("string"), F.col("value").cast("string"))
    d = t.events.select(F.col("user_id").alias("key"), F.array(row).alias("states"))
    out = NE.flatten_states(d, "states", [("callsign", 1, "string"), ("at", 2, "epoch"), ("speed", 3, "double")])
    return out.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("c21_cart_snapshot", """WITH l AS (SELECT * FROM (SELECT o_custkey AS cart_id, l_partkey AS product_id, l_quantity, l_returnflag, ROW_NUMBER() OVER
      (PARTITION BY o_custkey, l_partkey ORDER BY l_shipdate DESC, o_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lineitem JOIN orders ON o_orderkey = l_orderkey) WHERE rn = 1)
    SELECT cart_id, CAST(SUM(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER)) AS DOUBLE) AS total_price, CAST(COUNT(*) AS INTEGER) AS n_products
    FROM l JOIN part ON product_id = p_partkey WHERE l_returnflag <> 'R' GROUP BY cart_id""")
def c21(t):
    """Cart lines from order lines (a returned line removes the product), priced with the current product price."""
    e = (t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
         .select(F.col("o_custkey").alias("cart_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
                 F.when(F.col("l_returnflag") == "R", "REMOVE").otherwise("ADD").alias("action"), F.lit("OPEN").alias("cart_status"),
                 F.to_date("l_shipdate").alias("cart_date"), F.col("o_custkey").alias("user_id"), "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"))
    p = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
                      F.lit(True).alias("availability"), F.lit(1).alias("updated_at"))
    d = NE.cart_snapshot(e, p, ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"])
    return d.select("cart_id", F.col("total_price").cast("double").alias("total_price"), F.size("products").alias("n_products"))


@query("c22_normalize_out", "SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY ALL")
def c22(t):
    """Split (priority, status) into a side table, then join it back: counts must not change."""
    base, side = R.normalize_out(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"), "o_orderkey", ["o_orderpriority", "o_orderstatus"], "kind_id")
    return base.join(side, "kind_id").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("j24_expand_party", """WITH n AS (SELECT event_id, ts, event_type, 'a' || user_id AS account FROM events WHERE event_type = 'signup'),
    p AS (SELECT DISTINCT 'p' || (user_id // 3) AS party_id, 'a' || user_id AS account, 'c' || (user_id % 7) AS city FROM events),
    plan AS (SELECT 'a' || user_id AS account, 'plan ' || event_id AS plan_name FROM events WHERE event_type = 'purchase')
    SELECT n.event_id, p.party_id, m.account AS related_account_id, plan_name, p.city AS addr_city FROM n LEFT JOIN p ON n.account = p.account LEFT JOIN p m ON p.party_id = m.party_id LEFT JOIN plan ON plan.account = m.account""")
def j24(t):
    """Sign-ups spread to the three accounts of the user's party, with the plans each account bought and the address of the party."""
    from ..operators.joins import expand_party
    acc = F.concat(F.lit("a"), F.col("user_id").cast("string"))
    detail = F.struct(acc.alias("account_number"), F.concat(F.lit("plan "), F.col("event_id").cast("string")).alias("plan_name"))
    ev = t.events.select("event_id", F.col("event_id").cast("string").alias("event_time"), F.to_json(F.struct(F.col("event_type").alias("eventType"))).alias("context_data"),
                         F.array(F.to_json(detail)).alias("event_details"))
    info = t.events.select(F.concat(F.lit("p"), F.floor(F.col("user_id") / 3).cast("string")).alias("party_id"), acc.alias("account_number"),
                           F.concat(F.lit("c"), (F.col("user_id") % 7).cast("string")).alias("addr_city")).distinct()
    d = expand_party(ev, info, "signup", "purchase", keep="addr_city")
    return d.select(F.col("event_time").cast("bigint").alias("event_id"), "party_id", "related_account_id", "plan_name", "addr_city")
