"""CDC envelopes and changelogs."""

from pyspark.sql import functions as F

from ..operators import cdc as C, changelog as L
from .registry import query

COLS = ["user_id", "event_type", "value"]


def debezium(t):
    """Events as before/after envelopes: an error event is the delete of its user's row."""
    row = F.struct(*COLS)
    gone = F.col("event_type") == "error"
    return t.events.select("event_id", "ts", F.when(gone, F.lit("d")).otherwise(F.when(F.col("event_id") % 3 == 0, "c").otherwise("u")).alias("op"),
                           F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), F.struct((F.col("event_id") + 1704067200000).alias("ts_ms")).alias("source"))


@query("c01_unwrap_debezium", """SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' THEN 'd' WHEN event_id % 3 = 0 THEN 'c' ELSE 'u' END AS src_op, event_type = 'error' AS is_deleted FROM events""")
def c01(t):
    return C.unwrap_debezium(debezium(t), COLS, keep=["event_id"]).drop("src_timestamp")


@query("c02_unwrap_qlik", """SELECT user_id, value, event_id AS change_sequence, CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation, event_type = 'error' AS is_deleted
    FROM events WHERE value >= 3""")
def c02(t):
    gone = F.col("event_type") == "error"
    row = F.when(F.col("value") >= 3, F.struct("user_id", "value"))          # messages of small value are empty
    op = F.when(gone, "DELETE").when(F.col("event_type") == "signup", "INSERT").otherwise("UPDATE")
    env = t.events.select(F.struct(op.alias("operation"), F.col("event_id").alias("changeSequence"), F.col("ts").alias("timestamp")).alias("headers"),
                          F.when(~gone, row).alias("data"), F.when(gone, row).alias("beforeData"))
    return C.unwrap_qlik(env, ["user_id", "value"], key="user_id").drop("change_timestamp")


@query("c03_unwrap_json", "SELECT event_id, user_id, value, event_type = 'error' AS is_deleted, CASE WHEN event_type = 'error' THEN 'd' WHEN event_id % 3 = 0 THEN 'c' ELSE 'u' END AS src_op FROM events")
def c03(t):
    d = debezium(t)
    text = F.to_json(F.struct("op", F.col("source.ts_ms").alias("ts_ms"), "before", "after"))
    j = d.select("event_id", text.alias("msg"))
    return C.unwrap_json_cdc(j, "msg", {"user_id": "bigint", "value": "double"}, keep="event_id").drop("src_timestamp")


@query("c04_source_timestamp", "SELECT event_id, event_type = 'error' AS is_deleted, make_timestamp((event_id + 1704067200000) * 1000) AS src_timestamp FROM events")
def c04(t):
    return C.unwrap_debezium(debezium(t), [], keep="event_id").select("event_id", "is_deleted", F.col("src_timestamp").cast("timestamp_ntz").alias("src_timestamp"))


@query("c05_filter_ops", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'error')")
def c05(t):
    return C.filter_ops(t.events.select("event_id", "event_type"), "event_type", ["view", "error"])


@query("c06_cdc_latest", """SELECT user_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def c06(t):
    flat = C.unwrap_debezium(debezium(t), COLS, keep=["event_id", "ts"])
    return C.cdc_latest(flat, "user_id", ["ts", "event_id"]).select(*COLS)


@query("c07_merge", """WITH tgt AS (SELECT * FROM (SELECT user_id, event_id, ts, value, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-10') WHERE rn = 1),
    stg AS (SELECT * FROM (SELECT user_id, event_id, ts, value, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1)
    SELECT s.user_id, s.event_id, CASE WHEN s.event_type = 'error' THEN m.value ELSE s.value END AS value, s.event_type = 'error' AS deleted FROM stg s LEFT JOIN tgt m ON s.user_id = m.user_id
    WHERE m.user_id IS NULL OR (s.ts > m.ts AND s.value >= m.value)
    UNION ALL SELECT t.user_id, t.event_id, t.value, t.event_type = 'error' FROM tgt t LEFT JOIN stg s ON s.user_id = t.user_id WHERE s.user_id IS NULL OR NOT (s.ts > t.ts AND s.value >= t.value)""")
def c07(t):
    """Conditional merge: newer and not smaller wins, a delete keeps the old value."""
    from ..operators.dedup import dedup_last
    e = t.events.select("user_id", "event_id", "ts", "value", (F.col("event_type") == "error").alias("deleted"))
    tgt = dedup_last(e.filter("ts < timestamp_ntz'2024-01-10'"), "user_id", "ts")
    stg = dedup_last(e, "user_id", "ts")
    ch = C.merge_into(tgt, stg, "user_id", (F.col("s.ts") > F.col("m.ts")) & (F.col("s.value") >= F.col("m.value")), "deleted", "value")
    return C.apply_merge(tgt, ch, "user_id").select("user_id", "event_id", "value", "deleted")


def row_kinds(t):
    kind = F.when(F.col("event_type") == "error", "-D").when(F.col("event_type") == "signup", "-U").when(F.col("event_type") == "view", "+U").otherwise("+I")
    return t.events.select("user_id", "event_id", "value", kind.alias("row_kind"))


@query("c08_apply_changelog", """SELECT user_id, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events WHERE event_type <> 'signup') WHERE rn = 1 AND event_type <> 'error'""")
def c08(t):
    return L.apply_changelog(row_kinds(t), "user_id", "event_id")


@query("c09_to_retract", """WITH v AS (SELECT user_id, ts, event_id, value, LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
    SELECT CASE WHEN rn = 1 THEN '+I' ELSE '+U' END AS row_kind, user_id, value, event_id AS change_event_id FROM v UNION ALL
    SELECT '-U', user_id, old, event_id FROM v WHERE rn > 1""")
def c09(t):
    d = L.to_retract(t.events.select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], cols="value")
    return d.drop("change_ts")


@query("c09_retract_totals", "SELECT user_id % 10 AS grp, ROUND(SUM(value), 2) AS total, COUNT(*) AS n FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 GROUP BY 1")
def c09b(t):
    """Totals over the retract stream equal totals over the final table."""
    d = L.to_retract(t.events.select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], cols="value")
    r = L.retract_aggregate(d.withColumn("grp", F.col("user_id") % 10), "grp", "value")
    return r.withColumn("total", F.round("total", 2)).withColumn("n", F.col("n").cast("bigint"))


@query("c10_normalize", """WITH v AS (SELECT user_id, event_id, value, event_type = 'error' AS gone, LAG(CASE WHEN event_type = 'error' THEN NULL ELSE value END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM events)
    SELECT CASE WHEN old IS NULL THEN '+I' ELSE '+U' END AS row_kind, user_id, value, event_id AS change_event_id FROM v WHERE NOT gone UNION ALL
    SELECT CASE WHEN gone THEN '-D' ELSE '-U' END, user_id, old, event_id FROM v WHERE old IS NOT NULL""")
def c10(t):
    """Upserts with deletes to a full changelog."""
    e = t.events.select("user_id", "ts", "event_id", "value", (F.col("event_type") == "error").alias("gone"))
    d = L.normalize(e, "user_id", ["ts", "event_id"], F.col("gone"))
    return d.select("row_kind", "user_id", "value", "change_event_id")


@query("c11_tombstone_cascade", """WITH tomb AS (SELECT user_id % 30 AS g, MAX(ts) AS tomb FROM events WHERE event_type = 'signup' AND value > 60 GROUP BY 1)
    SELECT user_id % 30 AS g, COUNT(*) AS members, COUNT(*) FILTER (WHERE ts < tomb) AS deleted FROM events LEFT JOIN tomb ON user_id % 30 = g WHERE event_type <> 'signup' GROUP BY 1""")
def c11(t):
    from ..operators.joins import apply_group_tombstone
    signup = F.col("event_type") == "signup"
    r = t.events.filter(~signup | (F.col("value") > 60)).select((F.col("user_id") % 30).alias("g"), F.when(signup, "").otherwise("m").alias("member"), "ts", signup.alias("is_deleted"))
    return apply_group_tombstone(r, "g", "member", "ts", "is_deleted").groupBy("g").agg(F.count(F.lit(1)).alias("members"), F.count_if("is_deleted").alias("deleted"))


@query("c12_changelog_chain", """WITH o AS (SELECT * FROM (SELECT user_id, event_type AS product, value, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1),
    p AS (SELECT event_type AS product, arg_max(event_id, ts) AS origin FROM events WHERE event_type <> 'click' GROUP BY 1) SELECT o.user_id, o.product, o.value, p.origin FROM o LEFT JOIN p USING (product)""")
def c12(t):
    o = t.events.select("user_id", F.col("event_type").alias("product"), "value", "ts")
    p = t.events.filter("event_type <> 'click'").select(F.col("event_type").alias("product"), F.col("event_id").alias("origin"), F.col("ts").alias("p_ts"))
    return L.changelog_chain(o, ["user_id", "product"], "ts", p, "product", "p_ts").select("user_id", "product", "value", "origin")


@query("c13_rehydrate", """WITH log AS (SELECT event_id % 4000 AS k, * FROM events), d AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY ts DESC) AS rn FROM log) WHERE rn = 1)
    SELECT user_id, event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS usage FROM d GROUP BY ALL""")
def c13(t):
    """Usage totals from a replayed log in which events repeat (key = event_id % 4000)."""
    log = t.events.withColumn("k", F.col("event_id") % 4000)
    d = L.rehydrate(log, "k", "ts", ["user_id", "event_type"], {"n": ("count", "*"), "usage": ("sum", "value")})
    return d.withColumn("usage", F.round("usage", 2))


@query("c14_mix", """WITH u AS (SELECT event_id % 3000 AS k, event_id, ts, 1 AS pr, 'hist' AS src FROM events WHERE ts < TIMESTAMP '2024-01-15' UNION ALL SELECT event_id % 3000, event_id, ts, 0, 'live' FROM events WHERE ts >= TIMESTAMP '2024-01-15')
    SELECT k, event_id, src FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY pr, ts DESC) AS rn FROM u) WHERE rn = 1""")
def c14(t):
    e = t.events.select((F.col("event_id") % 3000).alias("k"), "event_id", "ts")
    return L.mix(e.filter("ts < timestamp_ntz'2024-01-15'"), e.filter("ts >= timestamp_ntz'2024-01-15'"), "k", "ts").select("k", "event_id", "src")


@query("c15_scd2_history", """SELECT * FROM (SELECT user_id, event_type, value, ts AS valid_from, LEAD(ts) OVER w AS valid_to, LEAD(ts) OVER w IS NULL AS is_current FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) WHERE event_type <> 'error'""")
def c15a(t):
    d = C.scd2_history(t.events.select("user_id", "event_type", "value", "ts"), "user_id", "ts", F.col("event_type") == "error")
    return d.select("user_id", "event_type", "value", "valid_from", "valid_to", "is_current")


@query("c15_scd2_step", """WITH a AS (SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-15') WHERE rn = 1),
    b AS (SELECT user_id, value, ts FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-20') WHERE rn = 1)
    SELECT a.user_id, a.value, a.ts AS valid_from, CASE WHEN b.user_id IS NULL THEN TIMESTAMP '2024-02-01' WHEN b.ts > a.ts THEN b.ts END AS valid_to FROM a LEFT JOIN b USING (user_id)
    UNION ALL SELECT b.user_id, b.value, b.ts, NULL FROM b LEFT JOIN a USING (user_id) WHERE a.user_id IS NULL OR b.ts > a.ts""")
def c15b(t):
    """One snapshot step: changed keys get a new version, vanished keys are closed."""
    from ..operators.dedup import dedup_last
    e = t.events.select("user_id", "value", "ts")
    first = dedup_last(e.filter("ts < timestamp_ntz'2024-01-15'"), "user_id", "ts")
    hist = first.select("*", F.col("ts").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    now = dedup_last(e.filter("ts >= timestamp_ntz'2024-01-20'"), "user_id", "ts")
    return C.scd2(hist, now, "user_id", "ts", "2024-02-01 00:00:00").select("user_id", "value", "valid_from", "valid_to")
