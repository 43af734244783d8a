"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a tree (domain, language, source) hold tokens. A token budget goes down from the root: at every node the children share
it by weight, and a child that cannot use its share (its leaves times the epochs allowed hold less) gives the rest back to
its siblings by their weights. A node is only short when all its children are, and only then its own siblings get the rest: shortages
are made good among siblings before ancestors. Every leaf then plays its documents in a seeded order, epoch after epoch, up to its budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from .shared import session, written

WORD = "[^\\x20\\x09-\\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def _weight(column: str, weights: Mapping[str, int]) -> Column:
    w = F.lit(weights.get("*", 1))
    for value, x in weights.items():
        if value != "*":
            w = F.when(F.col(column) == value, F.lit(x)).otherwise(w)
    return w.cast("double")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], share: float, epochs: int) -> DataFrame:
    """``levels, have, budget``: whole tokens for each leaf. ``leaves`` has the levels and ``have`` (tokens); ``share`` of all tokens is the target."""
    caps = leaves.withColumn("cap", F.col("have") * F.lit(float(epochs)))
    root = caps.agg(F.sum("have").alias("have"), F.sum("cap").alias("cap"))
    given = root.select(F.least(F.floor(F.col("have") * F.lit(share)).cast("double"), F.col("cap")).alias("given"))
    for k in range(1, len(levels) + 1):
        path, above = list(levels[:k]), list(levels[:k - 1])
        node = caps.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(levels[k - 1], weights.get(levels[k - 1], {}))).where("w > 0 and cap > 0")
        node = node.join(given, above) if above else node.crossJoin(F.broadcast(given))         # the root is one row
        order = Win.partitionBy(*above).orderBy(F.col("cap") / F.col("w"), levels[k - 1])
        before = F.coalesce(F.sum("cap").over(order.rowsBetween(Win.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("w").over(order.rowsBetween(0, Win.unboundedFollowing))
        node = node.withColumn("level", (F.col("given") - before) / rest)
        node = node.withColumn("level", F.max("level").over(Win.partitionBy(*above)))
        given = node.select(*path, F.least("cap", F.col("w") * F.col("level")).alias("given"))
    return leaves.join(given, list(levels), "left").select(*levels, "have", F.floor(F.coalesce("given", F.lit(0.0)) + F.lit(1e-6)).cast("long").alias("budget"))


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], share: float, epochs: int = 1, seed: int = 0) -> DataFrame:
    """The chosen documents: ``doc_id, <levels>, epoch, n_tokens, taken`` with one row for each document and epoch.

    ``levels`` names the tree's levels, root first, each with its expression over ``docs``; ``weights`` has integer weights by level and value
    (``*`` for values not named, 1 if absent). ``share`` of all tokens is the target. ``taken`` < ``n_tokens`` where the leaf's budget ends
    inside a document. Null levels count as ''. Documents without words are never chosen. Order within a leaf and epoch: md5 of
    ``seed:epoch:doc_id``, then doc_id; rows that repeat a doc_id stand next to each other. Rows without doc_id are ordered by their text
    and the place they were read from instead, each by itself: however many there are, they spread over all stretches.
    """
    session(docs.sparkSession)
    names = list(levels)
    place = F.concat_ws(":", F.xxhash64("text").cast("string"), F.monotonically_increasing_id().cast("string"))      # written below: it stays
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), token_count(F.col("text")).alias("n_tokens"),
                       F.coalesce(F.col("doc_id").cast("long").cast("string"), place).alias("_own"),
                       *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()])
    rows = written(rows, "tokens")
    leaves = budgets(rows.groupBy(*names).agg(F.sum("n_tokens").alias("have")), names, weights, share, epochs)
    leaves = written(leaves.where("budget > 0"), "budgets")
    full = F.floor(F.col("budget") / F.col("have")).cast("int")
    rest = F.col("budget") - full * F.col("have")
    chosen = rows.where("n_tokens > 0").join(leaves.select(*names, full.alias("full"), rest.alias("rest")), names)
    whole = chosen.where("full > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("epoch")).withColumn("taken", F.col("n_tokens"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.col("_own")))
    last = chosen.where("rest > 0").withColumns({"epoch": F.col("full"), "key": key, "bucket": F.substring(key, 1, 3)})
    # a leaf's running total: totals of up to 4,096 stretches of the key first, then within each stretch
    sums = last.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("t"))
    sums = sums.withColumn("before", F.sum("t").over(Win.partitionBy(*names).orderBy("bucket")) - F.col("t")).drop("t")
    inner = Win.partitionBy(*names, "bucket").orderBy("key", "doc_id", "n_tokens").rowsBetween(Win.unboundedPreceding, 0)
    last = last.join(sums, [*names, "bucket"]).withColumn("start", F.col("before") + F.sum("n_tokens").over(inner) - F.col("n_tokens"))
    last = last.where("start < rest").withColumn("taken", F.least(F.col("n_tokens"), F.col("rest") - F.col("start")))
    columns = ["doc_id", *names, "epoch", "n_tokens", "taken"]
    return whole.select(*columns).unionByName(last.select(*columns))
