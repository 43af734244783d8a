"""Streaming forms, run over whole tables to their end and compared with the batch SQL."""

from pyspark.sql import functions as F

from ..streaming import sequences as SQ, stateful as ST, streams as S
from .registry import QUERIES, query

DELAY = "1 minute"
NTZ = "timestamp_ntz"


def same_sql(name):
    from . import q_aggregates, q_changelog, q_dedup, q_features, q_joins, q_over, q_patterns, q_windows  # noqa: F401
    return QUERIES[name].sql


def events(t, build, **kw):
    return S.replay(t.spark, t.folder, "events", "ts", DELAY, build, **kw)


def back(d, *cols):
    return d.withColumns({c: F.col(c).cast(NTZ) for c in cols})


@query("w01_tumble_stream", same_sql("w01_tumble"))
def w01s(t):
    aggs = {"n": ("count", "*"), "total": ("sum", "value")}
    d = events(t, lambda s: S.stream_tumble(s, "ts", "1 hour", "event_type", aggs))
    d = back(d, "window_start", "window_end").withColumn("total", F.round("total", 2))
    return d.withColumn("mean", F.col("total") / F.col("n"))


@query("w02_hop_stream", same_sql("w02_hop_direct"))
def w02s(t):
    return back(events(t, lambda s: S.stream_hop(s, "ts", "6 hours", "12 hours", "event_type", {"low": ("min", "value"), "high": ("max", "value")})), "window_start", "window_end")


@query("w04_session_stream", same_sql("w04_session"))
def w04s(t):
    d = events(t, lambda s: S.stream_session(s, "ts", "8 hours", "user_id", {"n": ("count", "*"), "total": ("sum", "value")}))
    return back(d, "window_start", "window_end").withColumn("total", F.round("total", 2))


@query("w07_rolling_stream", same_sql("w07_rolling_features"))
def w07s(t):
    d = events(t, lambda s: S.stream_rolling_features(s, "ts", "user_id", "value"))
    return back(d, "feature_time").withColumns({c: F.round(c, 2) for c in ("amt_sum_6h", "amt_sum_12h")})


@query("w14_split_late", """WITH r AS (SELECT event_id, ts, MAX(ts) OVER (ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM (SELECT *, (event_id * 7919) % 10007 + event_id * 10 AS a FROM events))
    SELECT event_id, COALESCE(ts < high - INTERVAL '2 days', false) AS is_late FROM r""")
def w14(t):
    """Late rows by arrival order (ids shuffled by a fixed rule stand for arrival)."""
    a = (F.col("event_id") * 7919) % 10007 + F.col("event_id") * 10
    return S.split_late_batch(t.events.select("event_id", "ts", a.alias("a")), "ts", "a", "2 days").select("event_id", "is_late")


@query("o01_over_range_stream", same_sql("o01_over_range"))
def o01s(t):
    d = events(t, lambda s: ST.stream_over_range(S.without_beats(s, "ts"), "user_id", "ts", "1 day", "event_id", "value"))
    return d.select(F.col("label").cast("bigint").alias("event_id"), "n", F.round("total", 2).alias("total"))


@query("o02_over_rows_stream", same_sql("o02_over_rows"))
def o02s(t):
    d = events(t, lambda s: ST.stream_over_rows(S.without_beats(s, "ts"), "user_id", "ts", 10, "value", "event_id"))
    return d.select(F.col("id").cast("bigint").alias("event_id"), "n", "top")


@query("t05_first_per_value_stream", same_sql("t05_first_per_value"))
def t05s(t):
    d = events(t, lambda s: ST.stream_first_per_value(S.without_beats(s, "ts"), "user_id", "ts", "event_type", "event_id"))
    return d.select("user_id", "event_type", F.col("id").cast("bigint").alias("event_id"))


@query("t06_priority_stream", same_sql("t06_priority"))
def t06s(t):
    """The best row of each user so far, upserted by user."""
    from ..operators.dedup import dedup_last
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    d = events(t, lambda s: S.stream_dedup_priority(S.without_beats(s, "ts"), "user_id", rank, ["ts", "event_id"]), mode="update", keys=["user_id"])
    return dedup_last(d, "user_id", "_batch").select("user_id", "event_id", "event_type")


@query("w12_tumble_max_stream", same_sql("w12_tumble_max"))
def w12s(t):
    d = events(t, lambda s: S.stream_tumble_max(S.without_beats(s, "ts"), "ts", "1 day", None, ["value", "event_id"]))
    return back(d, "window_start").select("window_start", "event_id", "user_id", "value")


@query("w25_last_record_stream", same_sql("w25_last_record"))
def w25s(t):
    v = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    d = events(t, lambda s: S.stream_last_record(S.without_beats(s, "ts").withColumn("v", v), "ts", "1 day", "user_id", ["event_type", "v"]))
    return back(d, "window_start").drop("window_end")


@query("o03_running_total_stream", same_sql("o03_running_total"))
def o03s(t):
    d = events(t, lambda s: ST.stream_running_total(S.without_beats(s, "ts"), "user_id", "ts", "value", "event_id"))
    total = F.round("total", 2)
    return d.select(F.col("id").cast("bigint").alias("event_id"), total.alias("running_total"), (total > 500).alias("over_threshold"))


@query("o04_lag_stream", same_sql("o04_lag"))
def o04s(t):
    d = events(t, lambda s: ST.stream_lag(S.without_beats(s, "ts"), "user_id", "ts", "value", "event_id"))
    return d.select(F.col("id").cast("bigint").alias("event_id"), "value", F.col("prev_value").alias("previous_value"))


@query("o06_locf_stream", """SELECT event_id, LAST_VALUE(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events""")
def o06s(t):
    """Two of three values are taken away and filled by the last one before."""
    seen = F.when(F.col("event_id") % 3 == 0, F.col("value"))
    d = events(t, lambda s: ST.stream_locf(S.without_beats(s, "ts"), "user_id", "ts", seen, "event_id"))
    return d.select(F.col("id").cast("bigint").alias("event_id"), "value")


@query("o13_crossing_alerts_stream", same_sql("o13_crossing_alerts"))
def o13s(t):
    d = events(t, lambda s: ST.stream_crossing_alerts(S.without_beats(s, "ts"), "user_id", "ts", "1 day", "value", 300, 5, "event_id"))
    return back(d.select("user_id", "action", F.col("ts").alias("updated_at")), "updated_at")


@query("w03_cumulate_stream", same_sql("w03_cumulate"))
def w03s(t):
    """Growing windows, whole in the stream: every step of a day comes out when the watermark passes it."""
    d = events(t, lambda s: SQ.stream_cumulate(S.without_beats(s, "ts"), "event_type", "ts", "4 hours", "1 day", F.col("value")))
    return back(d, "window_start", "window_end").withColumn("total", F.round("total", 2))


@query("w11_distinct_stream", same_sql("w11_tumble_distinct"))
def w11s(t):
    """Distinct users per window, whole in the stream: distinct ids in one state, their count in the next."""
    d = events(t, lambda s: SQ.stream_tumble_distinct(S.without_beats(s, "ts"), "ts", "6 hours", "event_type", "user_id", "users"))
    return back(d, "window_start").select("window_start", "event_type", "users")


LATE_CUTS = ("2024-01-06", "2024-01-11", "2024-01-16", "2024-01-21", "2024-01-26")


@query("w14_split_late_stream", f"""WITH c AS (SELECT event_id, ts, LEAST({' + '.join(f"(ts >= TIMESTAMP '{c}')::INT" for c in LATE_CUTS)} + (event_id % 7 = 0)::INT, 5) AS arrival FROM events),
    h AS (SELECT arrival, MAX(ts) AS high FROM c GROUP BY 1)
    SELECT event_id, COALESCE(ts < (SELECT MAX(high) FROM h WHERE h.arrival < c.arrival) - INTERVAL '1 day', false) AS is_late FROM c""")
def w14s(t):
    """On-time and late tables of a stream whose rows with ids divisible by seven come a micro-batch late: which table each row went to."""
    from ..operators.relational import union_all
    from ..session import scratch_dir
    root = scratch_dir(t.spark, "late")
    source = S.in_slices(t.spark, t.folder, "events", "ts", 6, F.col("event_id") % 7 == 0, at=LATE_CUTS)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    S.split_late(t.spark, stream, "ts", "1 day", f"{root}/ok", f"{root}/late", f"{root}/marks", f"{root}/checkpoint")
    return union_all([t.spark.read.parquet(f"{root}/{n}").select("event_id", F.lit(n == "late").alias("is_late")) for n in ("ok", "late")])


def stages(kinds):
    from ..operators.patterns import Stage
    return [Stage(name, F.col("event_type") == kind, how) for name, kind, how in kinds]


@query("x02_sequence_stream", same_sql("x02_sequence_relaxed"))
def x02s(t):
    """view, the first purchase after it, any later error, within 2 days, from a stream."""
    pattern = stages([("a", "view", "followed_by"), ("b", "purchase", "followed_by"), ("c", "error", "followed_by_any")])
    return events(t, lambda s: SQ.stream_match_sequence(S.without_beats(s, "ts"), "user_id", "ts", pattern, "2 days", "event_id")).select("user_id", "matched")


@query("x02_sequence_dearer_stream", same_sql("x02_sequence_dearer"))
def x02ds(t):
    from .q_patterns import dearer
    return events(t, lambda s: SQ.stream_match_sequence(S.without_beats(s, "ts"), "user_id", "ts", dearer(), "2 days", "event_id", "value")).select("user_id", "matched")


@query("x01_match_runs_stream", same_sql("x01_match_runs"))
def x01s(t):
    d = events(t, lambda s: SQ.stream_match_runs(S.without_beats(s, "ts"), "event_type", "ts", "value", 35.0, "event_id"))
    stamp = lambda c: F.timestamp_micros(c).cast(NTZ)
    return d.select("event_type", stamp("start_us").alias("start_ts"), stamp("last_us").alias("last_ts"), F.round(F.col("avg_value") * F.col("n"), 2).alias("total"), "n")


@query("m01_anomalies_stream", same_sql("m01_anomalies"))
def m01s(t):
    """Bands from the user's earlier values, row by row (1e-9: see m01_anomalies)."""
    d = events(t, lambda s: SQ.stream_anomalies(S.without_beats(s, "ts"), "user_id", "ts", "value", "event_id", 96.0, 20))
    return d.select(F.col("id").cast("bigint").alias("event_id"), F.round(F.col("forecast_value") + 1e-9, 6).alias("forecast_value"), F.round("upper_bound", 2).alias("upper_bound"), "is_anomaly")


def folded(d, *cols):
    """Rows a changelog of +I and -D leaves."""
    sign = F.when(F.col("row_kind") == "-D", -1).otherwise(1)
    return d.groupBy(*cols).agg(F.sum(sign).alias("__n")).filter("__n > 0").drop("__n")


@query("j14_join_ttl_stream", """SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL '3 hours' AND p.ts + INTERVAL '1 hour'""")
def j14s(t):
    """Purchases wait an hour for views, views three hours for purchases; NULL rows are taken back when a match comes."""
    k = F.col("event_type")
    build = lambda s: SQ.stream_join_ttl(S.without_beats(S.pick(s, k.isin("view", "purchase")), "ts"), "user_id", "ts", k == "purchase", k == "view", "event_id", "1 hour", "3 hours", "left")
    d = folded(events(t, build), "left_id", "right_id")
    return d.select(F.col("left_id").cast("bigint").alias("event_id"), F.col("right_id").cast("bigint").alias("view_id"))


@query("j15_upsert_join_stream", """WITH f AS (SELECT user_id, event_type, arg_max(event_id, ts) AS event_id FROM events WHERE event_type <> 'view' GROUP BY ALL),
    d AS (SELECT user_id, arg_max(value, ts) AS price FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT f.user_id, f.event_type, f.event_id, d.price FROM f LEFT JOIN d USING (user_id)""")
def j15s(t):
    """Newest event of each type with the user's newest view value; every new value re-prices the user's rows only."""
    from ..operators.changelog import apply_changelog
    k = F.col("event_type")
    payload = F.when(k == "view", F.col("value").cast("string")).otherwise(F.col("event_id").cast("string"))
    d = events(t, lambda s: SQ.stream_join_upsert(S.without_beats(s, "ts"), "user_id", "ts", k != "view", k == "view", k, payload))
    d = apply_changelog(d.select("user_id", "row_kind", "fact_key", "fact", "dim", "seq"), ["user_id", "fact_key"], "seq")
    return d.select("user_id", F.col("fact_key").alias("event_type"), F.col("fact").cast("bigint").alias("event_id"), F.col("dim").cast("double").alias("price"))


@query("d04_top_n_stream", "SELECT user_id, event_id, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events WHERE value IS NOT NULL) WHERE rn <= 3")
def d04s(t):
    """Running top 3 of each user; displaced rows are taken back."""
    d = events(t, lambda s: SQ.stream_top_n(S.without_beats(s, "ts"), "user_id", "ts", "value", "event_id", 3))
    return folded(d, "user_id", "id", "value").select("user_id", F.col("id").cast("bigint").alias("event_id"), "value")


@query("c08_apply_changelog_stream", same_sql("c08_apply_changelog"))
def c08s(t):
    """The current row of each user from a log in which every fifth row comes a micro-batch late."""
    from ..operators.changelog import apply_changelog
    kind = F.when(F.col("event_type") == "signup", "-U").when(F.col("event_type") == "error", "-D").otherwise("+U")
    build = lambda s: SQ.stream_apply_changelog(S.without_beats(s, "ts"), "user_id", "ts", F.col("event_id"), kind, F.col("value").cast("string"))
    d = S.replay(t.spark, t.folder, "events", "ts", "40 days", build, late=F.col("event_id") % 5 == 0)
    d = apply_changelog(d, "user_id", "seq")
    return d.select("user_id", F.col("seq").alias("event_id"), F.col("payload").cast("double").alias("value"))


@query("c14_mix_stream", same_sql("c14_mix"))
def c14s(t):
    """History first, then the live log, which beats it whatever the times: live rows are numbered above all of history."""
    from ..operators.changelog import apply_changelog
    live = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    seq = F.unix_micros("ts") + F.when(live, F.lit(4 * 10**15)).otherwise(F.lit(0))
    payload = F.concat_ws(":", F.col("event_id").cast("string"), F.when(live, "live").otherwise("hist"))
    build = lambda s: SQ.stream_apply_changelog(S.without_beats(s, "ts").withColumn("k", F.col("event_id") % 3000), "k", "ts", seq, F.lit("+U"), payload)
    d = apply_changelog(events(t, build), "k", "seq")
    part = F.split("payload", ":")
    return d.select("k", part[0].cast("bigint").alias("event_id"), part[1].alias("src"))


@query("x09_cutoff_stream", """WITH b AS (SELECT DISTINCT time_bucket(INTERVAL '1 day', ts) AS day FROM events), tr AS (SELECT day + INTERVAL '11 hours 30 minutes' AS cutoff_ts FROM b UNION SELECT day + INTERVAL '35 hours 30 minutes' FROM b),
    d AS (SELECT cutoff_ts, e.*, ROW_NUMBER() OVER (PARTITION BY cutoff_ts, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM tr JOIN events e ON ts BETWEEN cutoff_ts - INTERVAL '24 hours' AND cutoff_ts)
    SELECT user_id, event_id, cutoff_ts AS ts FROM d WHERE rn = 1 AND ts <= cutoff_ts - INTERVAL '2 hours'""")
def x09s(t):
    """Daily 11:30 cutoff on a stream: users heard of in the last day but silent for two hours, by a timer for those who stay silent."""
    d = events(t, lambda s: SQ.stream_cutoff(S.without_beats(s, "ts"), "user_id", "ts", "event_id", "1 day", "690 minutes"))
    return back(d.select("user_id", F.col("id").cast("bigint").alias("event_id"), "ts"), "ts")


@query("j11_asof_stream", """SELECT p.event_id, v.ts AS v_ts, v.value AS rate FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT user_id, ts, MAX(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def j11s(t):
    """Purchases with the user's latest view at or before them, both from one stream, each out once the watermark has passed it."""
    k = F.col("event_type")
    payload = F.format_string("%024.6f", "value")
    build = lambda s: ST.stream_join_asof(S.without_beats(S.pick(s, k.isin("view", "purchase")), "ts"), "user_id", "ts", k == "purchase", k == "view", "event_id", payload)
    d = events(t, build)
    return back(d.select(F.col("id").cast("bigint").alias("event_id"), F.timestamp_micros("version_us").alias("v_ts"), F.col("version").cast("double").alias("rate")), "v_ts")


@query("j12_rules_stream", """WITH r AS (SELECT user_id, event_type, ts, MAX(value) AS max_value FROM events WHERE event_id % 10 = 0 GROUP BY ALL),
    e AS (SELECT * FROM events WHERE event_id % 10 <> 0)
    SELECT e.event_id, r.max_value FROM e ASOF JOIN r ON e.user_id = r.user_id AND e.event_type = r.event_type AND e.ts >= r.ts WHERE e.value > r.max_value""")
def j12s(t):
    """Events over the limit of the rule version valid at their time, by a composite key; every tenth row is a new rule version."""
    rule = F.col("event_id") % 10 == 0
    build = lambda s: ST.stream_join_asof(S.without_beats(s, "ts").withColumn("p", F.format_string("%024.6f", "value")), ["user_id", "event_type"], "ts", ~rule, rule,
                                          "event_key", F.col("p"))
    keyed = lambda s: s.withColumn("event_key", F.concat_ws(":", "event_id", "value"))
    d = events(t, lambda s: build(keyed(s))).filter("version is not null")
    part = F.split("id", ":")
    return (d.select(part[0].cast("bigint").alias("event_id"), part[1].cast("double").alias("v"), F.col("version").cast("double").alias("max_value"))
            .filter("v > max_value").select("event_id", "max_value"))


@query("o05_on_change_stream", same_sql("o05_on_change"))
def o05s(t):
    d = events(t, lambda s: ST.stream_on_change(S.without_beats(s, "ts"), "user_id", "ts", "event_type", "event_id"))
    return d.select(F.col("event_id").cast("bigint").alias("event_id"), "event_type")


@query("w18_count_window_stream", "WITH p AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS w FROM events) SELECT user_id, ROUND(SUM(value), 2) AS total, MAX(ts) AS last_ts FROM p GROUP BY user_id, w HAVING COUNT(*) = 10")
def w18s(t):
    d = events(t, lambda s: ST.stream_count_window(S.without_beats(s, "ts"), "user_id", "ts", 10, "value", "event_id"))
    return d.select("user_id", F.round("total", 2).alias("total"), F.timestamp_micros("last_us").cast(NTZ).alias("last_ts"))


@query("x08_missing_followup_stream", same_sql("x08_missing_followup"))
def x08s(t):
    k = F.col("event_type")
    d = events(t, lambda s: ST.stream_missing_followup(S.without_beats(S.pick(s, k.isin("view", "purchase")), "ts"), "user_id", "ts", k == "view", k == "purchase", "6 hours", "event_id"))
    return d.select(F.col("id").cast("bigint").alias("event_id"))


@query("x10_state_counter", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id")
def x10(t):
    """Per-key counter in a stateful processor, upserted by key."""
    d = events(t, lambda s: ST.stream_counter(S.without_beats(s, "ts"), "user_id"), mode="update", keys="user_id")
    from ..operators.dedup import dedup_last
    return dedup_last(d, "user_id", "_batch").select("user_id", "n")


@query("x11_dedup_ttl", """SELECT event_id FROM (SELECT event_id, ts, LAG(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events)
    WHERE before IS NULL OR ts - before > INTERVAL '2 days'""")
def x11(t):
    """First row per key; a key that was silent for more than two days counts as new."""
    build = lambda s: ST.stream_dedup_ttl(S.without_beats(s, "ts"), ["user_id", "event_type"], "ts", "event_id", "2 days")
    return events(t, build).select(F.col("id").cast("bigint").alias("event_id"))


@query("a20_upsert_sum_stream", same_sql("a20_upsert_sum"))
def a20s(t):
    """Update-mode totals upserted by key."""
    from ..operators.dedup import dedup_last
    build = lambda s: S.without_beats(s, "ts").groupBy("user_id", "event_type").agg(F.sum("value").alias("total"))
    d = events(t, build, mode="update", keys=["user_id", "event_type"])
    return dedup_last(d, ["user_id", "event_type"], "_batch").select("user_id", "event_type", F.round("total", 2).alias("total"))


@query("j10_interval_stream", same_sql("j10_interval"))
def j10s(t):
    def build(s):
        p = S.without_beats(S.pick(s, F.col("event_type") == "purchase"), "ts").select("event_id", "user_id", "ts")
        v = S.without_beats(S.pick(s, F.col("event_type") == "view"), "ts").select("user_id", F.col("ts").alias("v_ts"), F.col("value").alias("rate"))
        return S.stream_join_interval(p, v, "user_id", "ts", "v_ts", "-1 day", "2 hours").select("event_id", "v_ts", "rate")
    return back(events(t, build), "v_ts")


@query("j10_interval_left_stream", same_sql("j10_interval_left"))
def j10ls(t):
    def build(s):
        p = S.without_beats(S.pick(s, F.col("event_type") == "purchase"), "ts").select("event_id", "user_id", "ts")
        v = S.without_beats(S.pick(s, F.col("event_type") == "view"), "ts").select("user_id", F.col("ts").alias("v_ts"))
        return S.stream_join_interval(p, v, "user_id", "ts", "v_ts", "-1 day", "2 hours", "left").select("event_id", "v_ts")
    return back(events(t, build), "v_ts")


@query("j16_lookup_stream", "SELECT event_id, CASE WHEN c_custkey IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS lookup_status, c_name FROM events LEFT JOIN customer ON user_id = c_custkey")
def j16s(t):
    """Lookup against a table that is read again for every micro-batch."""
    from ..session import scratch_dir
    from ..sources.files import read_table_stream
    root = scratch_dir(t.spark, "lookup")
    dim = lambda: t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")

    def write(found, missing, i):
        found.unionByName(missing).write.mode("overwrite").parquet(f"{root}/out/_batch={i}")

    s = read_table_stream(t.spark, t.folder, "events", t.events.schema).select("event_id", "user_id")
    S.lookup_each_batch(s, dim, "user_id", write, f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out").select("event_id", "lookup_status", "c_name")


@query("j26_pair_once_stream", """WITH a AS (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'view'),
    b AS (SELECT user_id, event_id AS purchase_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase')
    SELECT a.user_id, a.event_id, purchase_id FROM a JOIN b USING (user_id, n)""")
def j26s(t):
    k = F.col("event_type")
    d = events(t, lambda s: ST.stream_pair_once(S.without_beats(S.pick(s, k.isin("view", "purchase")), "ts"), "user_id", "ts", k == "view", k == "purchase", "event_id"))
    return d.select("user_id", F.col("left_id").cast("bigint").alias("event_id"), F.col("right_id").cast("bigint").alias("purchase_id"))


@query("j17_lookup_refresh", "SELECT event_id, CASE WHEN s_suppkey IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS lookup_status, s_name FROM events LEFT JOIN supplier ON user_id = s_suppkey")
def j17(t):
    """Reference rows loaded anew for every micro-batch, result split into found and missing tables."""
    from ..operators.relational import union_all
    from ..session import scratch_dir
    from ..sources.files import read_table_stream
    root = scratch_dir(t.spark, "lookup")
    dim = lambda: t.supplier.select(F.col("s_suppkey").alias("user_id"), "s_name")

    def write(found, missing, i):
        found.write.mode("overwrite").parquet(f"{root}/found/_batch={i}")
        missing.write.mode("overwrite").parquet(f"{root}/missing/_batch={i}")

    s = read_table_stream(t.spark, t.folder, "events", t.events.schema).select("event_id", "user_id")
    S.lookup_each_batch(s, dim, "user_id", write, f"{root}/checkpoint")
    return union_all([t.spark.read.parquet(f"{root}/{n}").select("event_id", "lookup_status", "s_name") for n in ("found", "missing")])


@query("j17_lookup_cached", same_sql("j17_lookup_refresh"))
def j17c(t):
    """The same lookup through a cache of at most 40 keys that asks the table only for keys it lacks, over five micro-batches."""
    from ..operators.relational import union_all
    from ..session import scratch_dir
    root = scratch_dir(t.spark, "lookup")
    dim = t.supplier.select(F.col("s_suppkey").alias("user_id"), "s_name")
    cache = S.LookupCache(t.spark, lambda keys: dim.join(keys, "user_id", "left_semi"), "user_id", 40, 3600)

    def write(found, missing, i):
        found.write.mode("overwrite").parquet(f"{root}/found/_batch={i}")
        missing.write.mode("overwrite").parquet(f"{root}/missing/_batch={i}")

    source = S.in_slices(t.spark, t.folder, "events", "ts", 5)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(source).select("event_id", "user_id")
    S.lookup_cached(stream, cache, write, f"{root}/checkpoint")
    return union_all([t.spark.read.parquet(f"{root}/{n}").select("event_id", "lookup_status", "s_name") for n in ("found", "missing")])


@query("j31_heartbeat_window_join", """WITH w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, COUNT(*) FILTER (WHERE event_type = 'view') AS views, COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY ALL)
    SELECT window_start, user_id, views, purchases FROM w WHERE views > 0 AND purchases > 0""")
def j31(t):
    """Two windowed streams joined per (day, user); heartbeats move the time of both and leave no rows."""
    def build(s):
        count = lambda kind, name: S.stream_tumble(S.pick(s, F.col("event_type") == kind), "ts", "1 day", "user_id", {name: ("count_if", f"not {S.BEAT}")}).filter(F.col(name) > 0)
        return count("view", "views").join(count("purchase", "purchases"), ["window_start", "window_end", "user_id"]).drop("window_end")
    return back(events(t, build), "window_start")


@query("w13_watermark", "SELECT event_id, ts FROM events")
def w13(t):
    """Watermarked stream without a stateful step: late rows (every fifth row comes a micro-batch late) are not dropped."""
    d = events(t, lambda s: S.without_beats(s, "ts").select("event_id", "ts"), late=F.col("event_id") % 5 == 0)
    return back(d, "ts")


@query("w16_idle_sources", """SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, COUNT(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' OR event_type IN ('view', 'click') GROUP BY 1""")
def w16(t):
    """Sources (event types) that fall silent half-way do not hold back the windows of the others."""
    alive = (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz").cast("timestamp")) | F.col("event_type").isin("view", "click")
    return back(events(t, lambda s: S.stream_tumble(S.pick(s, alive), "ts", "1 day", None, {"n": ("count", "*")})), "window_start").drop("window_end")


@query("w16_sources_released", """WITH s AS (SELECT ts, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'rest' END AS source FROM events
    WHERE event_type IN ('view', 'click') OR ts < TIMESTAMP '2024-01-15'), m AS (SELECT source, MAX(ts) AS newest FROM s GROUP BY source),
    r AS (SELECT CASE WHEN newest < (SELECT MAX(newest) FROM m) - INTERVAL '2 days' THEN (SELECT MAX(newest) FROM m) ELSE newest END AS reached FROM m),
    w AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start FROM s)
    SELECT window_start, COUNT(*) AS n FROM w WHERE window_start + INTERVAL '1 day' <= (SELECT MIN(reached) FROM r) - INTERVAL '1 hour' GROUP BY 1""")
def w16_released(t):
    """Three streams with a watermark each; the one that falls silent is let go by a heartbeat, then the windows of the others come out."""
    spark = S.tune(t.spark.newSession())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    k, schema = F.coalesce("event_type", F.lit("")), t.events.schema
    until = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz").cast("timestamp")
    kinds = {"view": k == "view", "click": k == "click", "rest": ~k.isin("view", "click") & until}
    root = S.scratch_dir(spark, "sources")
    for n in kinds:
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/beats/{n}")
    sources = {n: (S.in_slices(t.spark, t.folder, "events", "ts", 3, only=c), f"{root}/beats/{n}") for n, c in kinds.items()}

    def once():
        d = S.union_of_sources(spark, sources, schema, "ts", "1 hour")
        d = S.stream_tumble(d, "ts", "1 day", None, {"n": ("count_if", f"not {S.BEAT}")}).filter("n > 0")
        S.run_stream(d, f"{root}/out", f"{root}/checkpoint")
    once()
    S.release_idle(spark, sources, schema, "ts", "2 days")
    once()
    return back(t.spark.read.parquet(f"{root}/out"), "window_start").select("window_start", "n")


@query("w17_processing_time", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type")
def w17(t):
    """Windows by processing time; their times are the run's own, so the counts are summed over them."""
    build = lambda s: S.processing_time_tumble(S.without_beats(s, "ts"), "1 hour", "event_type", {"n": ("count", "*")})
    d = events(t, build, mode="update", keys=["window_start", "event_type"])
    from ..operators.dedup import dedup_last
    last = dedup_last(d, ["window_start", "event_type"], "_batch")
    return last.groupBy("event_type").agg(F.sum("n").alias("n"))


@query("w21_allowed_lateness", "SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, COUNT(*) AS n FROM events GROUP BY 1")
def w21(t):
    """Update mode: every third row comes a micro-batch late and makes its window fire again; each firing replaces the one before it."""
    from ..operators.dedup import dedup_last
    build = lambda s: S.stream_tumble(s, "ts", "1 day", None, {"n": ("count_if", f"not {S.BEAT}")})
    out = S.replay(t.spark, t.folder, "events", "ts", S.lateness_delay("1 minute", "20 days"), build, mode="update", keys="window_start", late=F.col("event_id") % 3 == 0)
    d = dedup_last(out, "window_start", "_batch").filter("n > 0")
    return back(d.select("window_start", "n"), "window_start")


@query("d06_process_function", """SELECT user_id, event_id, CAST(date_diff('microsecond', LAG(ts) OVER w, ts) > 36000000000 AS BOOLEAN) AS long_pause FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def d06(t):
    """A user's own processor with state per key: flags rows that follow a pause of more than ten hours."""
    build = lambda s: ST.stream_pauses(S.without_beats(s, "ts"), "user_id", "ts", "event_id", "10 hours")
    return events(t, build).select("user_id", F.col("label").cast("bigint").alias("event_id"), "long_pause")
