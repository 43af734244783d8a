"""Scalar functions, JSON, user functions."""

import pandas as pd
from pyspark.sql import functions as F

from ..functions import scalar as S, udfs as U
from ..operators import joins as J
from .registry import query


@query("f01_case_trim", "SELECT p_partkey, UPPER(p_name) AS up, LOWER(p_brand) AS low, TRIM('  ' || p_type || ' ') AS tr, RTRIM(p_type || '  ') AS rt FROM part")
def f01(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
                         F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("tr"), F.rtrim(F.concat("p_type", F.lit("  "))).alias("rt"))


@query("f02_concat", "SELECT c_custkey, c_name || '/' || c_mktsegment AS a, concat_ws('-', c_mktsegment, NULL, CAST(c_nationkey AS VARCHAR)) AS b FROM customer")
def f02(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("/"), "c_mktsegment").alias("a"),
                             F.concat_ws("-", "c_mktsegment", F.lit(None).cast("string"), F.col("c_nationkey").cast("string")).alias("b"))


@query("f03_regex_functions", r"""SELECT c_custkey, replace(c_name, '#', '-') AS r, regexp_replace(c_name, '[0-9]{4}', 'N', 'g') AS rr,
    regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1) AS num, regexp_matches(c_mktsegment, '^(B|M)') AS bm FROM customer""")
def f03(t):
    return t.customer.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit("-")).alias("r"), F.regexp_replace("c_name", "[0-9]{4}", "N").alias("rr"),
                             F.regexp_extract("c_name", "#0*([1-9][0-9]*)$", 1).alias("num"), F.col("c_mktsegment").rlike("^(B|M)").alias("bm"))


@query("f04_substring", "SELECT p_partkey, substring(p_name, 1, 3) AS head, substring(p_name, 4) AS tail FROM part")
def f04(t):
    return t.part.select("p_partkey", F.substring("p_name", 1, 3).alias("head"), F.expr("substring(p_name, 4)").alias("tail"))


@query("f05_split_index", "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS first, string_split(o_orderpriority, '-')[2] AS second, string_split(o_orderpriority, '-')[5] AS fifth FROM orders")
def f05(t):
    s = lambda i: S.split_index("o_orderpriority", "-", i)
    return t.orders.select("o_orderkey", s(0).alias("first"), s(1).alias("second"), s(4).alias("fifth"))


@query("f06_row_hash", "SELECT c_custkey, md5(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS h FROM customer")
def f06(t):
    return t.customer.select("c_custkey", S.row_hash("c_custkey", "c_name", "c_mktsegment").alias("h"))


@query("f07_bucket", "SELECT event_id % 5 AS bucket, COUNT(*) AS n FROM events GROUP BY 1")
def f07(t):
    """Bucket of an integer key; ``bucket`` hashes keys of any type."""
    return t.events.groupBy(F.pmod("event_id", F.lit(5)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("f08_cast", r"""SELECT event_id, CAST(event_id AS VARCHAR) AS s, TRY_CAST(props AS INTEGER) AS bad, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
    CAST(user_id % 2 AS BOOLEAN) AS b, CAST(CAST(value AS DECIMAL(10,1)) AS DOUBLE) AS d1 FROM events""")
def f08(t):
    return t.events.select("event_id", F.col("event_id").cast("string").alias("s"), F.col("props").try_cast("int").alias("bad"),
                           F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"), (F.col("user_id") % 2).cast("boolean").alias("b"),
                           F.col("value").cast("decimal(10,2)").cast("decimal(10,1)").cast("double").alias("d1"))


@query("f09_conditionals", """SELECT event_id, COALESCE(NULLIF(event_type, 'error'), 'none') AS kind, CASE WHEN value > 50 THEN 'hi' END AS hi,
    CASE WHEN user_id > 50 THEN 1 ELSE 0 END AS flag FROM events""")
def f09(t):
    return t.events.select("event_id", F.coalesce(F.nullif(F.col("event_type"), F.lit("error")), F.lit("none")).alias("kind"),
                           F.when(F.col("value") > 50, "hi").alias("hi"), F.expr("if(user_id > 50, 1, 0)").alias("flag"))


@query("f10_greatest", "SELECT l_orderkey, l_linenumber, l_partkey, GREATEST(l_partkey, l_suppkey, l_orderkey) AS g FROM lineitem")
def f10(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.greatest("l_partkey", "l_suppkey", "l_orderkey").alias("g"))


@query("f11_decimal_arithmetic", """SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_returnflag""")
def f11(t):
    exact = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(exact).cast("double").alias("revenue"))


@query("f12_mod_seconds", "SELECT event_id, event_id % 30 AS m, CAST(EXTRACT(SECOND FROM ts) AS INTEGER) AS sec FROM events")
def f12(t):
    return t.events.select("event_id", (F.col("event_id") % 30).alias("m"), F.second("ts").alias("sec"))


@query("f13_parse_timestamp", """SELECT event_id, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_sec, TRY_CAST(event_type AS TIMESTAMP) AS bad FROM events""")
def f13(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts_sec"),
                           F.try_to_timestamp("event_type", F.lit("yyyy-MM-dd")).cast("timestamp_ntz").alias("bad"))


@query("f14_epoch", "SELECT event_id, make_timestamp(1704067200000000 + event_id * 1000000) AS s, make_timestamp(1704067200000000 + event_id * 1000) AS ms FROM events")
def f14(t):
    return t.events.select("event_id", S.epoch_to_timestamp(F.col("event_id") + 1704067200, 0).cast("timestamp_ntz").alias("s"),
                           S.epoch_to_timestamp(F.col("event_id") + 1704067200000, 3).cast("timestamp_ntz").alias("ms"))


@query("f15_from_unixtime", "SELECT event_id, strftime(make_timestamp((1704067200 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS txt FROM events")
def f15(t):
    return t.events.select("event_id", F.from_unixtime(F.col("event_id") + 1704067200).alias("txt"))


@query("f16_timestamp_arithmetic", """SELECT event_id, CAST(trunc(epoch(ts - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS hours, CAST(trunc(epoch(ts - TIMESTAMP '2024-01-01') / 86400) AS BIGINT) AS days,
    ts + INTERVAL '90 seconds' AS later FROM events""")
def f16(t):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return t.events.select("event_id", F.timestamp_diff("HOUR", start, "ts").alias("hours"), F.timestamp_diff("DAY", start, "ts").alias("days"),
                           (F.col("ts") + F.expr("INTERVAL 90 SECONDS")).alias("later"))


@query("f17_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, CAST(CAST(ts + INTERVAL '7 days' AS DATE) AS VARCHAR) AS week_later FROM events")
def f17(t):
    return t.events.select("event_id", F.to_date("ts").cast("string").alias("d"), F.to_date(F.col("ts") + F.expr("INTERVAL 7 DAYS")).cast("string").alias("week_later"))


@query("f18_date_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%d/%m/%Y %H:%M') AS eu FROM orders")
def f18(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("eu"))


@query("f19_date_parts", "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m, COUNT(*) AS n FROM orders GROUP BY ALL")
def f19(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))


@query("f20_rows", "SELECT c_custkey, c_name AS name, c_nationkey AS nation, c_acctbal AS bal FROM customer")
def f20(t):
    """Row constructor, row cast with new field names, nested access."""
    d = t.customer.select("c_custkey", F.struct("c_name", F.struct("c_nationkey", "c_acctbal")).cast("struct<name:string,place:struct<nation:int,bal:double>>").alias("r"))
    return d.select("c_custkey", "r.name", "r.place.nation", "r.place.bal")


@query("f21_arrays", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[64] AS DOUBLE) AS last, CAST(len(embedding) AS INTEGER) AS n FROM embeddings")
def f21(t):
    """1-based element access."""
    return t.embeddings.select("vec_id", F.element_at("embedding", 1).cast("double").alias("first"), F.element_at("embedding", 64).cast("double").alias("last"), F.size("embedding").alias("n"))


@query("f22_array_concat", "SELECT p_partkey, array_to_string(list_concat(string_split(p_name, ' '), [p_brand, p_type]), '|') AS tags FROM part")
def f22(t):
    return t.part.select("p_partkey", F.array_join(F.concat(F.split("p_name", " "), F.array("p_brand", "p_type")), "|").alias("tags"))


@query("f23_maps", "SELECT p_partkey, unnest(['brand', 'type']) AS key, unnest([p_brand, p_type]) AS value FROM part")
def f23(t):
    m = F.map_from_arrays(F.array(F.lit("brand"), F.lit("type")), F.array("p_brand", "p_type"))
    return t.part.select("p_partkey", F.explode(F.map_entries(m)).alias("e")).select("p_partkey", "e.key", "e.value")


@query("f24_empty_array_default", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 2 END AS n FROM part")
def f24(t):
    arr = F.when(F.col("p_partkey") % 3 != 0, F.split("p_name", " "))
    return t.part.select("p_partkey", F.size(F.coalesce(arr, F.array().cast("array<string>"))).alias("n"))


@query("f25_json_value", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def f25(t):
    return t.events.select("event_id", S.json_value("props", "$.k", "bigint").alias("k"), S.json_value("props", "$.missing").alias("missing"))


@query("f25_json_typed", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n FROM events GROUP BY 1")
def f25b(t):
    """Several fields at once: parse once with a schema."""
    return t.events.select(F.from_json("props", "k bigint").alias("p")).groupBy("p.k").agg(F.count(F.lit(1)).alias("n"))


@query("f26_json_query", """SELECT event_id, '{"a":' || user_id || '}' AS obj, '[1,' || user_id || ']' AS arr, '[' || user_id || ']' AS wrapped FROM events""")
def f26(t):
    doc = F.format_string('{"o":{"a":%d},"l":[1,%d],"s":%d}', "user_id", "user_id", "user_id")
    return t.events.select("event_id", S.json_query(doc, "$.o").alias("obj"), S.json_query(doc, "$.l").alias("arr"), S.json_query(doc, "$.s", wrap=True).alias("wrapped"))


@query("f27_json_rows", "SELECT event_id, unnest([1, 2]) AS a, unnest([event_type, 'x']) AS b FROM events")
def f27(t):
    doc = F.format_string('[{"a":1,"b":"%s"},{"a":2,"b":"x"}]', "event_type")
    return t.events.select("event_id", F.explode(S.json_rows(doc, "a int, b string")).alias("r")).select("event_id", "r.a", "r.b")


@query("f28_json_object", """SELECT event_id, '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS doc FROM events""")
def f28(t):
    return t.events.select("event_id", S.json_object(id="event_id", kind="event_type").alias("doc"))


@query("f29_ndjson", """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS line FROM customer""")
def f29(t):
    return t.customer.select("c_custkey", S.ndjson_line("c_custkey", "c_name").alias("line"))


@query("f30_typeof", "SELECT COUNT(*) AS n, 'bigint' AS id_type, 'double' AS value_type FROM events")
def f30(t):
    return t.events.agg(F.count(F.lit(1)).alias("n"), F.max(F.typeof("event_id")).alias("id_type"), F.max(F.typeof("value")).alias("value_type"))


@query("f31_sequence", "SELECT c_custkey, unnest(generate_series(0, c_custkey % 4)) AS i FROM customer")
def f31(t):
    return t.customer.select("c_custkey", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c_custkey") % 4)).alias("i"))


@query("f32_price_text", "SELECT p_partkey, p_retailprice AS price FROM part")
def f32(t):
    """'$1,234.50' text back to a number."""
    text = F.concat(F.lit("$"), F.format_number("p_retailprice", 2))
    return t.part.select("p_partkey", S.price_text(text).cast("double").alias("price"))


@query("f33_now", "SELECT event_id, ts < CAST(now() AS TIMESTAMP) AS past, true AS same_day FROM events")
def f33(t):
    """Current time and date; both are one value per query."""
    return t.events.select("event_id", (F.col("ts") < F.current_timestamp().cast("timestamp_ntz")).alias("past"), (F.current_date() == F.to_date(F.now())).alias("same_day"))


@query("f34_by_position", "SELECT event_id, event_type AS a, CAST(value AS VARCHAR) AS b FROM events")
def f34(t):
    arr = F.array(F.col("event_type"), F.col("value").cast("string"))
    return t.events.select("event_id", arr.alias("s")).select("event_id", F.element_at("s", 1).alias("a"), F.element_at("s", 2).alias("b"))


@query("d01_scalar_function", "SELECT event_id, value * 2 + 1 AS y FROM events")
def d01(t):
    f = U.scalar_function(lambda v: v * 2 + 1, "double")
    return t.events.select("event_id", f("value").alias("y"))


@query("d02_table_function", "SELECT doc_id, COUNT(*) AS n, CAST(MAX(length(w)) AS INTEGER) AS longest FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY doc_id")
def d02(t):
    d = J.join_lateral(t.documents.select("doc_id", "text"), U.split_words("text"), ["word", "length"])
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))


@query("d03_aggregate_function", "SELECT user_id, SUM(value) / COUNT(*) AS mean FROM (SELECT user_id, CAST(value * 100 AS INTEGER) AS value FROM events) GROUP BY user_id")
def d03(t):
    """Accumulator (sum, count) with a finishing step."""
    e = t.events.select("user_id", F.round(F.col("value") * 100).cast("int").alias("cents"))
    return U.accumulate(e, "user_id", {"s": F.sum("cents"), "n": F.count("cents")}, F.col("s") / F.col("n"), "mean")


@query("d04_table_aggregate", "SELECT user_id, event_id, value, CAST(rn AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events) WHERE rn <= 2")
def d04(t):
    return U.table_aggregate_top(t.events.select("user_id", "event_id", "value"), "user_id", ["value", "event_id"], 2)


@query("d05_external_call", "SELECT o_orderkey, o_orderpriority, CAST(length(o_orderpriority) AS BIGINT) AS answer FROM orders")
def d05(t):
    """Row-wise call by a thread pool per partition (the called function stands for the service)."""
    return U.call_external(t.orders.select("o_orderkey", "o_orderpriority"), lambda r: {"answer": len(r["o_orderpriority"])}, "o_orderpriority", "answer bigint")


@query("d07_eta", "SELECT event_id, ts + INTERVAL '1 day' AS eta_window_start, ts + INTERVAL '26 hours' AS eta_window_end, 0.5::DOUBLE AS risk_score, 0.8::DOUBLE AS confidence FROM events")
def d07(t):
    return t.events.select("event_id", U.estimate_delivery("ts").alias("e")).select("event_id", "e.*")


@query("d08_tax", "SELECT s_suppkey, CASE r WHEN 'USA' THEN 10 WHEN 'EU' THEN 5 ELSE 0 END AS tax FROM (SELECT s_suppkey, CASE s_nationkey % 3 WHEN 0 THEN 'USA' WHEN 1 THEN 'EU' ELSE 'ASIA' END AS r FROM supplier)")
def d08(t):
    k = F.col("s_nationkey") % 3
    d = t.supplier.select("s_suppkey", F.when(k == 0, "USA").when(k == 1, "EU").otherwise("ASIA").alias("r"))
    return d.select("s_suppkey", U.tax_by_location("r").alias("tax"))


@query("d09_geo_distance", """WITH g AS (SELECT event_id, radians((event_id % 180) - 90.0) AS a, radians((event_id % 360) - 180.0) AS lo, radians(48.85) AS b, radians(2.35) AS lo2 FROM events)
    SELECT event_id, ROUND(2 * 6371.0 * asin(sqrt(pow(sin((b - a) / 2), 2) + cos(a) * cos(b) * pow(sin((lo2 - lo) / 2), 2))), 4) AS km FROM g""")
def d09(t):
    lat, lon = F.col("event_id") % 180 - 90.0, F.col("event_id") % 360 - 180.0
    return t.events.select("event_id", F.round(S.haversine_km(lat, lon, F.lit(48.85), F.lit(2.35)), 4).alias("km"))


@query("d10_registered_function", "SELECT event_id, value + 1 AS y FROM events")
def d10(t):
    """The same function called by its registered name."""
    U.register(t.spark, "plus_one", lambda v: v + 1, "double")
    return t.events.select("event_id", F.expr("plus_one(value)").alias("y"))


@query("m06_predict", "SELECT event_id, ROUND(0.5 * value + 0.25 * user_id, 6) AS prediction FROM events")
def m06(t):
    """Batched model call with a local linear model."""
    weights = {"value": 0.5, "user_id": 0.25}

    def model(x: pd.DataFrame) -> pd.Series:
        return sum(x[c] * w for c, w in weights.items())

    d = U.predict(t.events.select("event_id", "value", "user_id"), model, ["value", "user_id"])
    return d.select("event_id", F.round("prediction", 6).alias("prediction"))
