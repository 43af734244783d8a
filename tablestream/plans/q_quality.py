"""Data quality."""

from pyspark.sql import functions as F, types as T

from ..operators import quality as Q, relational as R
from .registry import query


def people(t):
    """Customers as people rows with deliberate defects."""
    k = F.col("c_custkey")
    return t.customer.select(
        F.when(k % 11 != 0, k).alias("id"), "c_name",
        F.when(k % 4 == 0, F.concat(F.lit("bad"), k.cast("string"))).otherwise(F.concat(F.lit("u"), k.cast("string"), F.lit("@mail.example"))).alias("email"),
        F.when(k % 13 != 0, (k % 150 - 10).cast("int")).alias("age"))


PEOPLE = """(SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey END AS id, c_name, CASE WHEN c_custkey % 4 = 0 THEN 'bad' || c_custkey ELSE 'u' || c_custkey || '@mail.example' END AS email,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 150 - 10 AS INTEGER) END AS age FROM customer)"""


@query("q01_route_invalid", f"SELECT c_name, CASE WHEN id IS NULL THEN 'missing_id' WHEN age < 5 THEN 'too_young' END AS reject_reason FROM {PEOPLE}")
def q01(t):
    good, bad = Q.route_invalid(people(t), {"missing_id": F.col("id").isNull(), "too_young": F.col("age") < 5})
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad).select("c_name", "reject_reason")


@query("q01_envelope", """SELECT event_id, CASE WHEN value < 3 THEN 'missing_payload' WHEN event_type = 'view' THEN 'missing_key' END AS reject_reason FROM events WHERE value < 3 OR event_type = 'view'""")
def q01b(t):
    """Messages without payload or key go to the dead-letter side."""
    key = F.when(F.col("event_type") != "view", F.col("user_id"))
    env = t.events.select("event_id", F.struct(F.lit("UPDATE").alias("operation")).alias("headers"), F.when(F.col("value") >= 3, F.struct(key.alias("id"), "value")).alias("data"))
    return Q.route_invalid(env, Q.envelope_rules())[1].select("event_id", "reject_reason")


@query("q02_route_business", f"SELECT c_name, CASE WHEN email NOT LIKE '%@%' THEN 'bad_email' ELSE 'bad_age' END AS reject_reason FROM {PEOPLE} WHERE email NOT LIKE '%@%' OR age < 0")
def q02(t):
    return Q.route_business(people(t), "email", "age")[1].select("c_name", "reject_reason")


@query("q03_repair", f"SELECT c_name, CASE WHEN email LIKE '%@%' THEN email ELSE 'email_invalid' END AS email FROM {PEOPLE}")
def q03(t):
    return Q.repair(people(t), "email", F.col("email").rlike(Q.EMAIL_REPAIR), Q.INVALID_EMAIL).select("c_name", "email")


def checked(t):
    v = Q.validate_struct({"E1": (F.col("id").isNull(), "id is missing"), "E2": (F.col("age") > 120, "age out of range")})
    return people(t).withColumn("error", v)


@query("q04_validate_struct", f"SELECT c_name, CASE WHEN id IS NULL THEN 'E1' WHEN age > 120 THEN 'E2' END AS code FROM {PEOPLE}")
def q04(t):
    return checked(t).select("c_name", "error.code")


@query("q05_error_rows", f"SELECT CASE WHEN id IS NULL THEN 'E1' ELSE 'E2' END AS error_code, CASE WHEN id IS NULL THEN 'id is missing' ELSE 'age out of range' END AS error_message, c_name FROM {PEOPLE} WHERE id IS NULL OR age > 120")
def q05(t):
    """Error rows with the raw record kept as JSON (read back here)."""
    e = Q.to_error_rows(checked(t).withColumn("at", F.lit("2024-01-01").cast("timestamp")), "error", "at", ["c_name", "age"])
    return Q.decode_errors(e, "raw_data", {"c_name": "$.c_name"}).select("error_code", "error_message", "c_name")


@query("q06_not_null", f"SELECT c_name FROM {PEOPLE} WHERE id IS NULL")
def q06a(t):
    return Q.check_not_null(people(t), ["id", "email"]).select("c_name")


@query("q06_unique", "SELECT text_md5, COUNT(*) AS n FROM (SELECT md5(text) AS text_md5 FROM documents) GROUP BY 1 HAVING COUNT(*) > 1")
def q06b(t):
    return Q.check_unique(t.documents.select(F.md5("text").alias("text_md5")), "text_md5")


@query("q06_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def q06c(t):
    return Q.check_accepted_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"])


@query("q06_min_value", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def q06d(t):
    return Q.check_min_value(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 0)


@query("q06_relationship", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")
def q06e(t):
    return Q.check_relationship(t.events.select("event_id", "user_id"), "user_id", t.supplier, "s_suppkey").select("event_id", "user_id")


@query("q07_expect_equal", "SELECT CASE WHEN COUNT(*) = COUNT(DISTINCT o_orderkey) THEN 'PASS' ELSE 'FAIL' END AS test_result, COUNT(*) AS expected_rows, COUNT(*) AS actual_rows, COUNT(*) AS matching_rows FROM orders")
def q07(t):
    a = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return Q.expect_equal(a, t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderkey")


@query("q08_schema_contract", "SELECT COUNT(*) AS n, 1 AS violations FROM orders")
def q08(t):
    """Rows of a table next to the number of broken contract terms (one on purpose)."""
    broken = Q.assert_schema(t.orders, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "decimal(10,2)",
                                        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"})
    return Q.row_count(t.orders).withColumn("violations", F.lit(len(broken)))


@query("q09_infer_types", """SELECT 'o_orderkey' AS "column", 'INT' AS type, COUNT(*) AS n FROM orders UNION ALL SELECT 'o_totalprice', 'DECIMAL(18,2)', COUNT(*) FROM orders UNION ALL
    SELECT 'o_orderdate', 'TIMESTAMP', COUNT(*) FROM orders UNION ALL SELECT 'day', 'DATE', COUNT(*) FROM orders UNION ALL SELECT 'o_orderstatus', 'STRING', COUNT(*) FROM orders UNION ALL
    SELECT 'big', 'BIGINT', COUNT(*) FROM orders""")
def q09(t):
    """Narrowest types of text columns."""
    text = t.orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
                           F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
                           "o_orderstatus", (F.col("o_orderkey") + 3000000000).cast("string").alias("big"))
    return Q.infer_types(text)


@query("q10_validate_json", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'not json' WHEN event_id % 10 = 1 THEN 'missing kind' WHEN event_id % 10 = 2 THEN 'bad value' END AS error FROM events""")
def q10(t):
    k = F.col("event_id") % 10
    doc = (F.when(k == 0, F.lit("oops")).when(k == 1, F.format_string('{"id": %d}', "event_id"))
           .when(k == 2, F.lit('{"id": "x", "kind": "a"}')).otherwise(F.format_string('{"id": %d, "kind": "%s"}', "event_id", "event_type")))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType())])
    ok, bad = Q.validate_json(t.events.select("event_id", doc.alias("doc_text")), "doc_text", schema, ["id", "kind"])
    return ok.select("event_id", F.lit(None).cast("string").alias("error")).unionByName(bad.select("event_id", "error"))


@query("q11_row_count", "SELECT COUNT(*) AS n FROM lineitem")
def q11(t):
    return Q.row_count(t.lineitem)


@query("q12_error_rate", "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, 'E' || (event_id % 4) AS code, COUNT(*) AS error_count FROM events WHERE event_type = 'error' GROUP BY ALL")
def q12a(t):
    e = t.events.filter("event_type = 'error'").withColumn("code", F.concat(F.lit("E"), (F.col("event_id") % 4).cast("string")))
    return Q.error_rate(e, "ts", "code").drop("window_end")


@query("q12_top_errors", """SELECT 'E' || (event_id % 4) AS code, 'k' || json_extract_string(props, '$.k') AS message, COUNT(*) AS frequency, COUNT(DISTINCT user_id) AS records_affected
    FROM events WHERE event_type = 'error' AND ts BETWEEN TIMESTAMP '2024-01-13' AND TIMESTAMP '2024-01-20' GROUP BY ALL ORDER BY frequency DESC, code, message LIMIT 10""")
def q12b(t):
    e = t.events.filter("event_type = 'error'").select("ts", "user_id", F.concat(F.lit("E"), (F.col("event_id") % 4).cast("string")).alias("code"),
                                                       F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("message"))
    return Q.top_errors(e, "ts", "code", "message", "user_id", "2024-01-20 00:00:00", "7 days")


@query("q13_route_unparseable", "SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN date_trunc('second', ts)::TIMESTAMP END AS parsed_ts FROM events")
def q13(t):
    text = F.when(F.col("event_id") % 6 == 0, "2024-13-45 99:00:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    ok, bad = Q.route_unparseable(t.events.select("event_id", text.alias("raw")), "raw", "yyyy-MM-dd HH:mm:ss")
    return (ok.select("event_id", F.col("parsed_ts").cast("timestamp_ntz").alias("parsed_ts"))
            .unionByName(bad.select("event_id", F.lit(None).cast("timestamp_ntz").alias("parsed_ts"))))


@query("q14_decode_errors", "SELECT event_id, user_id AS record_id FROM events WHERE event_type = 'error'")
def q14(t):
    """Fields read back from stored error bytes."""
    raw = F.encode(F.to_json(F.struct(F.col("user_id").alias("id"))), "UTF-8")
    e = t.events.filter("event_type = 'error'").select("event_id", raw.alias("raw"))
    return Q.decode_errors(e, "raw", {"record_id": "$.id"}).withColumn("record_id", F.col("record_id").cast("bigint"))


@query("s19_route", """SELECT CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS sink, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def s19(t):
    sinks = R.route(t.orders, {"done": F.col("o_orderstatus") == "F", "open": F.col("o_orderstatus") == "O"}, rest="other")
    return R.union_all([d.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).select(F.lit(s).alias("sink"), "n", "total") for s, d in sinks.items()])
