"""Sources: tables written in a source format first, then read back through the reader under test."""

from pyspark.sql import functions as F, types as T

from ..functions import scalar as S
from ..session import scratch_dir
from ..sources import files as R, topic as TP
from .registry import query

EVENT_JSON = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


@query("s01_read_csv", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def s01(t):
    """CSV with declared schema; blanks around values are trimmed."""
    p = scratch_dir(t.spark, "csv")
    t.orders.select("o_orderkey", "o_custkey", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("pri"), "o_totalprice").write.csv(p)
    return R.read_csv(t.spark, p, "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_totalprice double")


@query("s02_read_json", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS user_id, event_type, value FROM events WHERE value >= 2
    UNION ALL SELECT NULL, NULL, NULL, NULL FROM events WHERE value < 2""")
def s02(t):
    """JSON lines with missing fields and broken lines."""
    p = scratch_dir(t.spark, "json")
    k = F.col("event_id")
    doc = F.to_json(F.struct("event_id", F.when(k % 4 != 0, F.col("user_id")).alias("user_id"), "event_type", "value"))
    t.events.select(F.when(F.col("value") < 2, F.lit('{"event_id": ')).otherwise(doc).alias("value")).write.text(p)
    return R.read_json(t.spark, p, EVENT_JSON).drop(R.CORRUPT)


@query("s03_topic_values", "SELECT event_id, user_id, event_type, value, CAST(event_id % 4 AS INTEGER) AS partition FROM events")
def s03(t):
    """Rows as a topic would hand them over (binary value, partition), parsed to columns."""
    raw = t.events.select(F.encode(F.to_json(F.struct("event_id", "user_id", "event_type", "value")), "UTF-8").alias("value"),
                          (F.col("event_id") % 4).cast("int").alias("partition"))
    return TP.parse_values(raw, EVENT_JSON).select("event_id", "user_id", "event_type", "value", "partition")


@query("s04_snapshot", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def s04(t):
    return R.read_snapshot(t.spark, t.path("events")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s05_wire_header", "SELECT event_id, 7 AS schema_id, event_type FROM events")
def s05(t):
    """Registry-framed values: 1 magic byte, 4 id bytes, body."""
    body = F.encode(F.to_json(F.struct("event_type")), "UTF-8")
    framed = t.events.select("event_id", F.concat(F.unhex(F.lit("0000000007")), body).alias("value"))
    return framed.select("event_id", S.wire_schema_id("value").alias("schema_id"), F.get_json_object(S.decode_bytes(S.strip_wire_header("value")), "$.event_type").alias("event_type"))


@query("s06_decode_bytes", "SELECT c_custkey, c_name FROM customer")
def s06(t):
    return t.customer.select("c_custkey", F.encode("c_name", "UTF-8").alias("b")).select("c_custkey", S.decode_bytes("b").alias("c_name"))


@query("s07_metadata", "SELECT 'events.parquet' AS file_name, COUNT(*) AS n FROM events")
def s07(t):
    return R.with_metadata(t.events).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


@query("s09_values", "SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON o_orderstatus = code")
def s09(t):
    """Inline code list joined to the orders."""
    v = R.values(t.spark, [("F", "finished"), ("O", "open")], "o_orderstatus string, label string")
    return t.orders.join(v, "o_orderstatus").select("o_orderkey", "label")


@query("s10_read_text", "SELECT COUNT(*) AS n, CAST(SUM(length(c_name)) AS BIGINT) AS chars FROM customer")
def s10(t):
    p = scratch_dir(t.spark, "text")
    t.customer.select(F.col("c_name").alias("value")).write.text(p)
    return R.read_text(t.spark, p).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


@query("s22_empty_like", "SELECT o_orderstatus, COUNT(*) AS n, 0 AS discounts FROM orders GROUP BY o_orderstatus")
def s22(t):
    """A table made from another one's schema plus a column, filled by a union that allows missing columns."""
    e = R.empty_like(t.orders, {"discount": "double"})
    u = e.unionByName(t.orders, allowMissingColumns=True)
    return u.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count("discount").cast("int").alias("discounts"))


@query("s27_comments", "SELECT o_orderkey, o_totalprice FROM orders")
def s27(t):
    return R.with_comments(t.orders.select("o_orderkey", "o_totalprice"), {"o_totalprice": "order total in local currency"})
