"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams of host and path.

The model is fitted on a small labelled table of URLs (at most ``MOST_LABELLED`` rows) and has a fixed number of weights, so it travels
with the tasks. Scoring is one pass over the URLs: no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .shared import session

# Fixed values: (verdict, host and path of the rule)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

# Labelled URLs are made by rule: a subject joined with words that sites of both kinds have in their names, so that the subject decides.
# Subjects of unwanted sites are the usual categories of block lists (gambling, medicines, adult, advertising, fraud, spam).
BAD_SUBJECTS = ("adult", "ads", "adserver", "bet", "betting", "bets", "casino", "clickbait", "counterfeit", "fakes", "gambling", "jackpot", "loans", "lottery", "payday", "pharmacy",
                "phishing", "pills", "poker", "popup", "porn", "replica", "roulette", "scam", "singles", "slots", "spam", "spyware", "tracker", "tracking", "viagra", "warez", "xxx")
GOOD_SUBJECTS = ("aquarium", "astronomy", "bakery", "botany", "cathedral", "chess", "archive", "council", "cycling", "farmers", "fire", "football", "garden", "geology", "harbour",
                 "history", "hospital", "institute", "kitchen", "library", "mountain", "museum", "music", "newsroom", "orchestra", "parish", "planetarium", "railway", "redwood",
                 "sailing", "school", "science", "shelter", "teacher", "theatre", "town", "travel", "university", "weather", "zoo")
SITE_WORDS = ("online", "world", "club", "best", "my", "hub", "zone", "the", "daily", "shop")
PREFIXES, ENDINGS = ("", "www.", "blog.", "m."), (".example.com", ".example.net", ".example.org")
PATHS = ("/", "/en/18244.html", "/about", "/de/3071/", "/fr/9924?page=2", "/es/5518", "/2021/05/notes")
EACH_BAD, EACH_GOOD = 4, 10             # labelled URLs of a subject: most sites are ordinary ones

BUCKETS, GRAMS = 1 << 15, (3, 4, 5)
MOST_LABELLED = 10_000
LIMIT = 0.6                             # of the registered query: blocks 1.2 % of the ordinary and 6 % of the unwanted sites of subjects left out of the fit
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, bad``: the labelled table that the registered query is fitted on."""
    rows = []
    for bad, each, subjects in ((1, EACH_BAD, BAD_SUBJECTS), (0, EACH_GOOD, GOOD_SUBJECTS)):
        for i, subject in enumerate(subjects):
            for j in range(each):
                site = SITE_WORDS[(3 * i + j) % len(SITE_WORDS)]
                name = (subject, f"{subject}-{site}", f"{site}-{subject}", f"{site}{subject}")[j % 4]
                rows.append((f"http{'s' * (j % 2)}://{PREFIXES[(i + j) % 4]}{name}{ENDINGS[(i + j) % 3]}{PATHS[(2 * i + j) % len(PATHS)]}", bad))
    return spark.createDataFrame(rows, "url string, bad int")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substring(url, at + 3, F.lit(2**31 - 1))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none. A rule fits its host and all subdomains, and paths that start as its own."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        cut = rule.index("/")
        fits = ((host == rule[:cut]) | host.endswith("." + rule[:cut])) & path.startswith(rule[cut:])
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram; host and path have marks of their own, so their n-grams differ."""
    urls = [b"\x01" + h.encode() + b"\x01\x02" + p.encode() + b"\x02" for h, p in zip(hosts, paths)]
    data = np.frombuffer(b"".join(urls), np.uint8).astype(np.uint64)
    size = np.array([len(u) for u in urls])
    row = np.repeat(np.arange(len(urls)), size)
    field = np.concatenate([np.repeat([1, 2], [len(h.encode()) + 2, len(p.encode()) + 2]) for h, p in zip(hosts, paths)]) if urls else np.zeros(0, int)
    rows, buckets = [], []
    for k in GRAMS:
        n = len(data) - k + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint64)
        for i in range(k):
            code = code * np.uint64(257) + data[i:i + n]
        whole = (row[:n] == row[k - 1:]) & (field[:n] == field[k - 1:])
        code = W.mix(code + field[:n].astype(np.uint64) * np.uint64(1 << 48))
        rows.append(row[:n][whole])
        buckets.append((code[whole] % np.uint64(BUCKETS)).astype(np.int64))
    return (np.concatenate(rows), np.concatenate(buckets)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _sums(weights: np.ndarray, hosts: list[str], paths: list[str]) -> np.ndarray:
    row, bucket = _grams(hosts, paths)
    n = np.bincount(row, minlength=len(hosts))
    return np.bincount(row, weights=weights[bucket], minlength=len(hosts)) / np.sqrt(np.maximum(n, 1))


def fit(labelled: DataFrame, most: int = MOST_LABELLED, steps: int = 300, rate: float = 20.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent on at most ``most`` labelled rows (``url, bad``), chosen by a hash of host and path; no rows give a model that blocks nothing."""
    host, path = host_path(F.col("url"))
    rows = labelled.where("bad is not null").select(host.alias("h"), path.alias("p"), F.col("bad").cast("double").alias("y"))
    rows = rows.orderBy(F.xxhash64("h", "p"), "h", "p", "y").limit(most).collect()       # the same rows whatever the partitions
    weights = np.zeros(BUCKETS)
    if not rows:
        return weights, -5.0
    hosts, paths, y = [r.h for r in rows], [r.p for r in rows], np.array([r.y for r in rows])
    row, bucket = _grams(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(row, weights=weights[bucket], minlength=len(y)) * scale + bias)))
        slip = (p - y) / len(y)
        weights -= rate * (np.bincount(bucket, weights=(slip * scale)[row], minlength=BUCKETS) + decay * weights)
        bias -= 0.1 * slip.sum()
    return weights, bias


def _score(weights: np.ndarray, bias: float):
    def run(batches):
        for b in batches:
            at = b.schema.names.index("host")
            z = _sums(weights, b.column(at).to_pylist(), b.column(at + 1).to_pylist()) + bias
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-z)))], names=[*b.schema.names, "score"])
    return run


def judge(pages: DataFrame, model: tuple[np.ndarray, float], rules=RULES, limit: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row; only ``page_id`` and ``url`` are read.

    The verdict is the rule's, else ``block`` from a score of ``limit`` on. Urls without ``://`` and null urls have empty host and
    path, no rule, and the score of a text without n-grams of letters. Repeated rows and null ids are judged each by itself.
    """
    session(pages.sparkSession)
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).na.fill("", ["host", "path"])
    kind = rows.schema["page_id"].dataType.simpleString()
    scored = rows.mapInArrow(_score(*model), f"page_id {kind}, host string, path string, score double")
    met = rule_for(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(met["verdict"], F.when(F.col("score") >= limit, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", met["rule"].alias("rule"), verdict.alias("verdict"), "score")
