"""Features and anomalies."""

from pyspark.sql import functions as F

from ..operators import features as M
from .registry import query


def values(t):
    return t.events.select("event_id", "user_id", "event_type", "ts", F.col("value").alias("v"))


@query("m01_anomalies", """WITH e AS (SELECT event_id, user_id, ts, value AS v FROM events),
    p AS (SELECT event_id, v, COUNT(*) OVER w AS n, AVG(v) OVER w AS m, STDDEV(v) OVER w AS sd FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, CASE WHEN n >= 20 THEN ROUND(m + 1e-9, 6) END AS forecast_value, CASE WHEN n >= 20 THEN ROUND(m + 2.0537 * sd, 2) END AS upper_bound,
      n >= 20 AND (v < m - 2.0537 * sd OR v > m + 2.0537 * sd) AS is_anomaly FROM p""")
def m01(t):
    """Values outside the confidence band of the user's earlier values (at least 20 of them).

    Means of cents over 32 or 64 values end in an exact 5 at the seventh digit, where the last bit of a float sum would decide how two
    engines round; 1e-9 on both sides moves such means off the border.
    """
    d = M.detect_anomalies(values(t), "user_id", ["ts", "event_id"], "v", 96.0, 20)
    return d.select("event_id", F.round(F.col("anomaly.forecast_value") + 1e-9, 6).alias("forecast_value"), F.round("anomaly.upper_bound", 2).alias("upper_bound"), "anomaly.is_anomaly")


@query("m01_anomalies_rolling", """WITH e AS (SELECT event_id, user_id, ts, value AS v FROM events),
    p AS (SELECT event_id, v, COUNT(*) OVER w AS n, AVG(v) OVER w AS m, STDDEV(v) OVER w AS sd FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT event_id, n >= 10 AND (v < m - 1.96 * sd OR v > m + 1.96 * sd) AS is_anomaly FROM p""")
def m01b(t):
    d = M.detect_anomalies_rolling(values(t), "user_id", ["ts", "event_id"], "v", 30, 95.0, 10)
    return d.select("event_id", "anomaly.is_anomaly")


@query("m02_mad", """WITH m AS (SELECT event_type, QUANTILE_CONT(value, 0.5) AS med FROM events GROUP BY 1),
    d AS (SELECT event_id, e.event_type, value, med, ABS(value - med) AS dev FROM events e JOIN m USING (event_type)), k AS (SELECT event_type, QUANTILE_CONT(dev, 0.5) AS mad FROM d GROUP BY 1)
    SELECT event_id, ROUND(0.6745 * dev / mad, 8) AS robust_z FROM d JOIN k USING (event_type) WHERE mad > 0 AND 0.6745 * dev / mad > 3.5""")
def m02(t):
    return M.detect_anomalies_mad(t.events.select("event_id", "event_type", "value"), "event_type", "value").select("event_id", F.round("robust_z", 8).alias("robust_z"))


@query("m03_escalate", """WITH e AS (SELECT event_id, user_id, ts, value AS v FROM events),
    p AS (SELECT event_id, v, COUNT(*) OVER w AS n, AVG(v) OVER w AS m, STDDEV(v) OVER w AS sd FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, v FROM p WHERE n >= 20 AND (v < m - 2.5758 * sd OR v > m + 2.5758 * sd)""")
def m03(t):
    return M.escalate(M.detect_anomalies(values(t), "user_id", ["ts", "event_id"], "v", 99.0, 20)).select("event_id", "v")


@query("m04_burst_injection", "SELECT event_id, ROUND(CASE WHEN CAST(EXTRACT(SECOND FROM ts) AS INTEGER) % 30 <= 5 THEN value + 20 ELSE value END, 2) AS temp FROM events")
def m04(t):
    return t.events.select("event_id", F.round(M.burst_injection("value", "ts"), 2).alias("temp"))


@query("m05_risk_score", """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 0.7::DOUBLE WHEN o_totalprice > 200000 AND o_orderstatus = 'O' THEN 0.5::DOUBLE WHEN o_totalprice > 200000 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END AS fraud_score,
    CASE WHEN o_totalprice > 400000 THEN 'AMOUNT_ANOMALY' WHEN o_totalprice > 200000 AND o_orderstatus = 'O' THEN 'ONLINE_HIGH_VALUE' WHEN o_totalprice > 200000 THEN 'HIGH_VALUE' ELSE 'NORMAL' END AS fraud_category,
    CASE WHEN o_totalprice > 400000 THEN 'HIGH' WHEN o_totalprice > 200000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM orders""")
def m05(t):
    return M.risk_score(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), "o_totalprice", F.col("o_orderstatus") == "O", 400000, 200000).drop("o_totalprice", "o_orderstatus")


@query("m07_feature_join", """SELECT p.event_id, CASE WHEN p.ts - v.ts <= INTERVAL '12 hours' THEN v.value END AS rate FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def m07(t):
    """Newest feature at or before the label, no older than 12 hours."""
    from ..operators.temporal import feature_join
    from .q_joins import purchases, views
    return feature_join(purchases(t), views(t), "user_id", "ts", "v_ts", "12 hours").select("event_id", "rate")


@query("m08_derived_features", "SELECT event_id, value + user_id AS rate_plus_1, value + event_id AS rate_plus_2 FROM events")
def m08(t):
    return M.derive_features(t.events, {"rate_plus_1": F.col("value") + F.col("user_id"), "rate_plus_2": F.col("value") + F.col("event_id")}).select("event_id", "rate_plus_1", "rate_plus_2")


@query("m09_vector_topk", """WITH q AS (SELECT label, arg_min(vec_id, vec_id) AS qid, arg_min(embedding, vec_id) AS qv FROM embeddings GROUP BY label),
    s AS (SELECT qid, vec_id, list_cosine_similarity(qv::DOUBLE[], embedding::DOUBLE[]) AS score FROM q, embeddings)
    SELECT qid, vec_id, CAST(rn AS INTEGER) AS rank, ROUND(score, 6) AS score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rn FROM s) WHERE rn <= 5""")
def m09(t):
    """Five nearest vectors by cosine for the first vector of each label."""
    q = t.embeddings.groupBy("label").agg(F.min_by("vec_id", "vec_id").alias("qid"), F.min_by("embedding", "vec_id").alias("qv")).drop("label")
    d = M.vector_topk(q, t.embeddings.select("vec_id", "embedding"), 5, "qid", "vec_id", "embedding", "qv", block_rows=200)
    return d.select("qid", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("m09_vector_topk_pruned")
def m09p(t):
    """The same for every embedding whose id is divisible by 50, through 64 centroids of which a query meets the 40 nearest (recall at ten 0.9 or more: these vectors hardly cluster)."""
    base = t.embeddings.select("vec_id", "embedding")
    q = base.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qv"))
    d = M.vector_topk(q, base, 10, "qid", "vec_id", "embedding", "qv", centroids=M.fit_centroids(base, "vec_id", "embedding"), probes=40)
    return d.select("qid", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("m10_text_search", r"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS term FROM documents)
    SELECT doc_id, COUNT(DISTINCT term) AS terms_found, COUNT(*) AS hits FROM w WHERE term IN ('the', 'and', 'license') GROUP BY doc_id""")
def m10(t):
    return M.text_search(t.documents, "doc_id", "text", ["the", "and", "license"])
