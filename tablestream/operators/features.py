"""Feature and anomaly computation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .aggs import exact_quantile
from .core import Keys, as_list, join_null_safe
from .dedup import top_n
from .over import over_rows
from .sequence import earlier_moments

# Score, category and level of the risk rules, strongest first.
RISK = (("0.7", "AMOUNT_ANOMALY", "HIGH"), ("0.5", "ONLINE_HIGH_VALUE", "MEDIUM"), ("0.3", "HIGH_VALUE", "MEDIUM"), ("0.1", "NORMAL", "LOW"))
# Two-sided normal quantiles of the usual confidence levels (percent).
Z_OF_CONFIDENCE = {90.0: 1.6449, 95.0: 1.9600, 96.0: 2.0537, 98.0: 2.3263, 99.0: 2.5758, 99.9: 3.2905}


def band(value: Column, n: Column, mean: Column, m2: Column, z: float, min_train: int) -> Column:
    """Forecast, bounds and verdict from the moments of earlier values (no verdict before ``min_train`` of them)."""
    v, sd = value.cast("double"), F.sqrt(m2 / F.nullif(n - 1, F.lit(0)))
    ok, lo, hi = n >= min_train, mean - sd * z, mean + sd * z
    return F.struct(F.when(ok, mean).alias("forecast_value"), F.when(ok, lo).alias("lower_bound"), F.when(ok, hi).alias("upper_bound"),
                    F.coalesce(ok & ((v < lo) | (v > hi)), F.lit(False)).alias("is_anomaly"))


def detect_anomalies(df: DataFrame, keys: Keys, order: Keys, value: str, confidence: float = 95.0, min_train: int = 50,
                     name: str = "anomaly") -> DataFrame:
    """Flag values outside mean +- z * stddev of the key's *earlier* values.

    Count, mean and squared distances grow row by row and are merged from chunk to chunk, so a band never knows a later value, however
    large. A NULL or NaN value is never flagged; NULLs do not train. No ARIMA model is fitted: the forecast is the mean.
    """
    z = Z_OF_CONFIDENCE[float(confidence)]
    d = earlier_moments(df, keys, order, F.col(value))
    return d.select(*df.columns, band(F.col(value), F.col("__n"), F.col("__mean"), F.col("__m2"), z, min_train).alias(name))


def detect_anomalies_rolling(df: DataFrame, keys: Keys, order: Keys, value: str, last_n: int = 100, confidence: float = 95.0,
                             min_train: int = 50, name: str = "anomaly") -> DataFrame:
    """As ``detect_anomalies``, trained on the last ``last_n`` rows before the row only."""
    z, v = Z_OF_CONFIDENCE[float(confidence)], F.col("__v")
    aggs = {"__n": F.count(v), "__mean": F.avg(v), "__var": F.var_pop(v)}
    d = over_rows(df.withColumn("__v", F.col(value).cast("double")), keys, order, last_n, aggs, upto=-1)
    return d.select(*df.columns, band(v, F.col("__n"), F.col("__mean"), F.col("__var") * F.col("__n"), z, min_train).alias(name))


def detect_anomalies_mad(df: DataFrame, keys: Keys, value: str, threshold: float = 3.5) -> DataFrame:
    """Rows whose robust z-score 0.6745 * |v - median| / MAD is over the threshold.

    Median and MAD are exact and computed without gathering a key (``exact_quantile``).
    """
    k = as_list(keys)
    med = cut_lineage(exact_quantile(df, k, value, 0.5, "median"))          # one row per key, used four times below
    dev = join_null_safe(df, med, k).withColumn("__dev", F.abs(F.col(value) - F.col("median")))
    mad = exact_quantile(dev, k, "__dev", 0.5, "mad")
    score = F.when(F.col("mad") > 0, F.lit(0.6745) * F.col("__dev") / F.col("mad"))
    out = join_null_safe(dev, mad, k).withColumn("robust_z", score)
    return out.filter(F.col("robust_z") > threshold).drop("__dev")


def escalate(df: DataFrame, name: str = "anomaly") -> DataFrame:
    return df.filter(F.col(f"{name}.is_anomaly"))


def burst_injection(value: str, ts: str, extra: float = 20.0) -> Column:
    """Test shape: raise the value in seconds 0-5 of each half minute."""
    return F.when(F.second(ts) % 30 <= 5, F.col(value) + extra).otherwise(F.col(value))


def risk_score(df: DataFrame, amount: str, online: Column, high: float = 1000, medium: float = 500) -> DataFrame:
    """Rule-based risk: score, category and level of a transaction."""
    a = F.col(amount)
    row = [F.struct(F.lit(float(score)).alias("fraud_score"), F.lit(cat).alias("fraud_category"), F.lit(level).alias("risk_level")) for score, cat, level in RISK]
    r = F.when(a > high, row[0]).when((a > medium) & online, row[1]).when(a > medium, row[2]).otherwise(row[3])
    return df.withColumn("__r", r).select(*df.columns, "__r.*")


def derive_features(df: DataFrame, features: dict[str, Column]) -> DataFrame:
    """On-demand features from stored and request values."""
    return df.withColumns(features)


CELL_ROWS, CELL_QUERIES = 12_500, 1_000           # of one matrix product: 100 MB of scores


def _unit(col: pd.Series) -> np.ndarray:
    m = np.asarray(col.tolist(), dtype="float64")
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def fit_centroids(base: DataFrame, bid: str, vec: str, n: int = 64, sample: int = 64, rounds: int = 10) -> np.ndarray:
    """``n`` directions around which the vectors lie, by spherical k-means on at most ``n * sample`` rows (the same rows each time)."""
    rows = base.filter(F.col(vec).isNotNull()).orderBy(F.xxhash64(bid), bid).limit(n * sample).select(vec).toPandas()
    if not len(rows):
        return np.zeros((0, 0))
    points = _unit(rows[vec])
    centres = points[np.random.default_rng(0).permutation(len(points))[:n]]
    for _ in range(rounds):
        near = (points @ centres.T).argmax(axis=1)
        sums = np.stack([points[near == i].sum(axis=0) if (near == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def _nearest(df: DataFrame, vec: str, centroids: np.ndarray, n: int) -> DataFrame:
    """Rows with ``__near``: the ``n`` centroids nearest to their vector."""
    n = min(n, len(centroids))

    def run(batches):
        for pdf in batches:
            score = _unit(pdf[vec]) @ centroids.T if len(pdf) else np.zeros((0, len(centroids)))
            yield pdf.assign(__near=list(np.argsort(-score, axis=1, kind="stable")[:, :n].astype("int32")))
    ddl = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInPandas(run, f"{ddl}, __near array<int>")


def vector_topk(queries: DataFrame, base: DataFrame, k: int, qid: str, bid: str, vec: str, qvec: str,
                block_rows: int = CELL_ROWS, slice_rows: int = CELL_QUERIES, centroids: np.ndarray | None = None, probes: int = 8) -> DataFrame:
    """Cosine top-k of each query vector: exact, or pruned by ``centroids``.

    Base rows are cut into blocks and queries into slices of bounded size; one matrix product per (block,
    slice) cell gives all scores of the cell and only the best ``k`` per query leave it, so no pair table
    is built. The final top-k runs over k rows per query and block. Scores are rounded to 12 digits; ties go by id.
    With ``centroids`` (see ``fit_centroids``) every base row is filed under the nearest one, and a query meets the rows of its ``probes``
    nearest only; what it meets is scored exactly. How many cells there are is worked out inside the query, not on the driver.
    """
    size = lambda df, rows: df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows)).cast("int")).scalar()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    b = base.select(F.col(bid).alias("bid"), F.col(vec).alias("v")).filter("v is not null")
    q = queries.select(F.col(qid).alias("qid"), F.col(qvec).alias("v")).filter("v is not null").withColumn("slices", size(queries, slice_rows))
    if centroids is None:
        b = b.withColumn("blocks", size(base, block_rows)).withColumn("part", F.lit(0))
        q = q.withColumn("blocks", size(base, block_rows)).withColumn("part", F.lit(0))
    else:
        b = _nearest(b, "v", centroids, 1).withColumn("part", F.get("__near", F.lit(0))).drop("__near")
        q = _nearest(q, "v", centroids, probes).withColumn("part", F.explode("__near")).drop("__near")
        sizes = b.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))       # a row a centroid
        b, q = b.join(F.broadcast(sizes), "part"), q.join(F.broadcast(sizes), "part")
    b = b.withColumn("slices", size(queries, slice_rows))
    b = b.select("part", "bid", "v", F.pmod(F.xxhash64("bid"), F.col("blocks")).cast("int").alias("blk"), every("slices").alias("sl"))
    q = q.select("part", "qid", "v", F.pmod(F.xxhash64("qid"), F.col("slices")).cast("int").alias("sl"), every("blocks").alias("blk"))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            scores, ids = np.round(_unit(right["v"]) @ _unit(left["v"]).T, 12), left["bid"].to_numpy()
            for i, query in enumerate(right["qid"].tolist()):
                if len(ids) > k:                             # the k-th best score, then all rows that reach it
                    row = np.flatnonzero(scores[i] >= np.partition(scores[i], len(ids) - k)[len(ids) - k])
                else:
                    row = np.arange(len(ids))
                best = row[np.lexsort((ids[row], -scores[i][row]))[:k]]
                out += [[query, ids[j], scores[i, j]] for j in best]
        return pd.DataFrame(out, columns=["qid", "bid", "score"])

    t = {**dict(queries.dtypes), **dict(base.dtypes)}
    cells = ("part", "blk", "sl")
    best = b.groupBy(*cells).cogroup(q.groupBy(*cells)).applyInPandas(cell, f"qid {t[qid]}, bid {t[bid]}, score double")
    return top_n(best, "qid", [F.col("score").desc(), F.col("bid").asc()], k, rank="rank").withColumnsRenamed({"qid": qid, "bid": bid})


def text_search(df: DataFrame, doc_id: str, text: str, terms: list[str], pattern: str = r"\W+") -> DataFrame:
    """Documents with any of the terms: distinct terms found and total hits."""
    words = df.select(doc_id, F.explode(F.split(F.lower(F.col(text)), pattern)).alias("term")).filter(F.col("term").isin(*terms))
    per = words.groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy(doc_id).agg(F.count(F.lit(1)).alias("terms_found"), F.sum("c").alias("hits"))
