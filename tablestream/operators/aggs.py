"""Grouped aggregates. Everything here combines on the map side before it shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .core import Aggs, Keys, as_list, finish_aggs, join_null_safe, merge_aggs, partial_aggs

# Bands of hot keys, hottest first (over the 99th and 95th percentile, over 1.5 times the third quartile, the rest).
BANDS = ("EXTREME_HOT", "VERY_HOT", "HOT", "NORMAL")


def agg(df: DataFrame, keys: Keys | None, aggs: Aggs) -> DataFrame:
    """``{"n": ("count", "*"), "total": ("sum", "amount")}`` by key, or over all rows without keys."""
    k = as_list(keys)
    return df.groupBy(*k).agg(*partial_aggs(aggs)).select(*k, *finish_aggs(aggs))


def agg_having(df: DataFrame, keys: Keys, aggs: Aggs, having: Column) -> DataFrame:
    return agg(df, keys, aggs).filter(having)


def agg_two_phase(df: DataFrame, keys: Keys, aggs: Aggs, salt_by: Keys, n: int = 16) -> DataFrame:
    """Aggregate by (key, salt) first, then by key: at most n rows per key reach the final task.

    Hash aggregates combine per map task anyway; this helps when the map side cannot
    (a streaming state, or many thousand map tasks on one hot key).
    """
    k = as_list(keys)
    salt = F.pmod(F.xxhash64(*as_list(salt_by)), F.lit(n))
    part = df.withColumn("__salt", salt).groupBy(*k, "__salt").agg(*partial_aggs(aggs))
    return part.groupBy(*k).agg(*merge_aggs(aggs)).select(*k, *finish_aggs(aggs))


def count_distinct(df: DataFrame, keys: Keys | None, cols: Keys, name: str = "n") -> DataFrame:
    """COUNT(DISTINCT c1, c2, ..): distinct rows first, so no set is built per group."""
    k, c = as_list(keys), as_list(cols)
    present = F.lit(True)
    for x in c:
        present = present & F.col(x).isNotNull()
    d = df.select(*dict.fromkeys([*k, *c])).distinct()
    return d.groupBy(*k).agg(F.count_if(present).alias(name))


def rate(df: DataFrame, keys: Keys | None, hit: Column, name: str = "pct", digits: int = 2) -> DataFrame:
    k = as_list(keys)
    return df.groupBy(*k).agg(F.round(F.count_if(hit) * 100.0 / F.count(F.lit(1)), digits).alias(name))


def collect(df: DataFrame, keys: Keys, col: str, name: str = "items", distinct: bool = False) -> DataFrame:
    """ARRAY_AGG, sorted so that equal input gives equal output.

    The result is one array per key by definition; use a key whose groups are small (an order, a window).
    """
    fn = F.collect_set if distinct else F.collect_list
    return df.groupBy(*as_list(keys)).agg(F.sort_array(fn(col)).alias(name))


def collect_rows(df: DataFrame, keys: Keys, fields: Keys, name: str = "items") -> DataFrame:
    return df.groupBy(*as_list(keys)).agg(F.sort_array(F.collect_list(F.struct(*as_list(fields)))).alias(name))


def collect_parts(df: DataFrame, keys: Keys, order: Keys, fields: Keys, part_rows: int, name: str = "items") -> DataFrame:
    """ARRAY_AGG of rows in parts of at most ``part_rows``, in order: for groups that may be huge.

    ``part`` counts from 0; a group that fits has one part. ``order``: time or number column, then tie breakers.
    """
    from .sequence import position
    k, f = as_list(keys), as_list(fields)
    d = position(df, k, order, "__pos")
    d = d.withColumn("part", F.floor((F.col("__pos") - 1) / part_rows).cast("int"))
    packed = F.sort_array(F.collect_list(F.struct("__pos", F.struct(*f).alias("r"))))
    return d.groupBy(*k, "part").agg(F.transform(packed, lambda x: x["r"]).alias(name))


def collect_multiset(df: DataFrame, keys: Keys, col: str, name: str = "items") -> DataFrame:
    """COLLECT: distinct values with their multiplicity, counted before they are gathered."""
    k = as_list(keys)
    c = df.groupBy(*k, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return c.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias(name))


def listagg(df: DataFrame, keys: Keys, col: str, sep: str = ",", order_by: str | None = None,
            name: str = "items") -> DataFrame:
    order = F.struct(F.col(order_by or col).alias("o"), F.col(col).cast("string").alias("v"))
    packed = F.sort_array(F.collect_list(F.when(F.col(col).isNotNull(), order)))
    return df.groupBy(*as_list(keys)).agg(F.array_join(F.transform(packed, lambda x: x["v"]), sep).alias(name))


def latest_value(df: DataFrame, keys: Keys, value: str, ts: str, name: str | None = None,
                 skip_nulls: bool = False) -> DataFrame:
    """MAX_BY: the value at the latest time; NULL there stays NULL unless ``skip_nulls``."""
    at = F.when(F.col(value).isNotNull(), F.col(ts)) if skip_nulls else F.col(ts)
    return df.groupBy(*as_list(keys)).agg(F.max_by(value, at).alias(name or value))


def min_rec(df: DataFrame, keys: Keys, by: Keys) -> DataFrame:
    """The whole record with the smallest ``by`` (unlike ``min`` of one field)."""
    from .dedup import dedup_first
    return dedup_first(df, keys, as_list(by))


def max_rec(df: DataFrame, keys: Keys, by: Keys) -> DataFrame:
    from .dedup import dedup_last
    return dedup_last(df, keys, as_list(by))


def avg_by(df: DataFrame, keys: Keys | None, col: str, name: str = "avg") -> DataFrame:
    k = as_list(keys)
    s = df.groupBy(*k).agg(F.sum(col).alias("total"), F.count(col).alias("n"))
    return s.withColumn(name, F.col("total") / F.col("n"))


def argmax_group(df: DataFrame, keys: Keys, value: str, name: str = "total") -> DataFrame:
    """The group with the largest sum (ties: smallest key)."""
    k = as_list(keys)
    return (df.groupBy(*k).agg(F.sum(value).alias(name))
            .orderBy(F.col(name).desc(), *[F.col(x).asc() for x in k]).limit(1))


def word_count(df: DataFrame, col: str, pattern: str = r"\s+") -> DataFrame:
    words = df.select(F.explode(F.split(F.lower(F.col(col)), pattern)).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def key_stats(counts: DataFrame, col: str = "n") -> DataFrame:
    """One row: mean, standard deviation and exact quartile / tail quantiles of a *per-key* column.

    ``percentile`` keeps a value -> frequency map. Counts per key that differ add up to at most the row
    count, so a table of n rows has fewer than sqrt(2n) of them, whatever the number of keys.
    """
    p = F.percentile(col, F.array(F.lit(0.75), F.lit(0.95), F.lit(0.99)))
    return counts.agg(F.avg(col).alias("mean_count"), F.stddev(col).alias("stddev_count"), p.alias("p")).select(
        "mean_count", "stddev_count", F.col("p")[0].alias("q3"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"))


def hot_keys(df: DataFrame, keys: Keys) -> DataFrame:
    """Keys above the mean with z-score and band. The one-row statistics join as scalar columns."""
    k = as_list(keys)
    counts = df.groupBy(*k).agg(F.count(F.lit(1)).alias("record_count"))
    stats = key_stats(counts, "record_count")
    d = with_stats(counts, stats)
    z = F.when(F.col("stddev_count") > 0, (F.col("record_count") - F.col("mean_count")) / F.col("stddev_count")).otherwise(0.0)
    band = (F.when(F.col("record_count") > F.col("p99"), BANDS[0])
            .when(F.col("record_count") > F.col("p95"), BANDS[1])
            .when(F.col("record_count") > F.col("q3") * 1.5, BANDS[2]).otherwise(BANDS[3]))
    return (d.filter(F.col("record_count") > F.col("mean_count"))
            .withColumn("z_score", z).withColumn("hot_key_category", band)
            .select(*k, "record_count", "mean_count", "stddev_count", "z_score", "hot_key_category"))


def with_stats(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame next to every row, as a scalar subquery (no cross join)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("s"))
    return df.select("*", packed.scalar().alias("__s")).select(*df.columns, "__s.*")


def dedup_stats(df: DataFrame, keys: Keys) -> DataFrame:
    """Total rows, distinct keys, removed rows and their share."""
    per = df.groupBy(*as_list(keys)).agg(F.count(F.lit(1)).alias("c"))
    s = per.agg(F.sum("c").alias("total_rows"), F.count(F.lit(1)).alias("unique_rows"))
    removed = F.col("total_rows") - F.col("unique_rows")
    return s.select("total_rows", "unique_rows", removed.alias("removed_rows"),
                    F.round(removed * 100.0 / F.col("total_rows"), 2).alias("removed_pct"))


def recency_counts(df: DataFrame, keys: Keys | None, ts: str, as_of: str, days: tuple[int, ...] = (30, 90)) -> DataFrame:
    """Rows of the last n days before an explicit as-of date (never the wall clock)."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col(ts).cast("date"))
    return df.groupBy(*as_list(keys)).agg(
        *[F.count_if((age >= 0) & (age <= d)).alias(f"last_{d}_days") for d in days])


def rollup_totals(df: DataFrame, fine: Keys, coarse: Keys, value: str, name: str = "total") -> DataFrame:
    """Totals per fine key, then per coarse key."""
    per = df.groupBy(*as_list(fine)).agg(F.sum(value).alias("__t"))
    return per.groupBy(*as_list(coarse)).agg(F.sum("__t").alias(name), F.count(F.lit(1)).alias("n_parts"))


def dedup_then_agg(df: DataFrame, row_key: Keys, order_by, keys: Keys, aggs: Aggs) -> DataFrame:
    """Exact totals from a log with repeats: last row per key, then the aggregate."""
    from .dedup import dedup_last
    return agg(dedup_last(df, row_key, order_by), keys, aggs)


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def exact_quantile(df: DataFrame, keys: Keys, value: str, p: float, name: str, bins: int = 256) -> DataFrame:
    """Exact interpolated quantile per key without gathering a key in one task.

    A quantile sketch per key cuts the values into bins, counts per (key, bin) locate the bins that
    hold the wanted ranks, and only the distinct values of those bins are ordered. The sketch decides
    how evenly the work is cut, never the result.
    """
    k = as_list(keys)
    d = df.select(*k, F.col(value).alias("v")).filter("v is not null")
    cuts = d.groupBy(*k).agg(F.percentile_approx("v", F.array(*[F.lit(i / bins) for i in range(1, bins)]), 1000).alias("cuts"))
    vc = d.groupBy(*k, "v").agg(F.count(F.lit(1)).alias("c"))
    binned = (join_null_safe(vc, cuts, k)
              .withColumn("bin", F.size(F.filter("cuts", lambda x: x < F.col("v")))).drop("cuts"))
    per_bin = binned.groupBy(*k, "bin").agg(F.sum("c").alias("bc"))
    w = Window.partitionBy(*k)
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = (per_bin.withColumn("after", F.sum("bc").over(upto)).withColumn("n", F.sum("bc").over(w))
              .withColumn("before", F.col("after") - F.col("bc"))
              .withColumn("at", (F.col("n") - 1) * F.lit(float(p)))
              .withColumn("lo", F.floor("at")).withColumn("hi", F.ceil("at"))
              .filter("(lo >= before and lo < after) or (hi >= before and hi < after)")
              .select(*k, "bin", "before", "at", "lo", "hi"))
    w2 = Window.partitionBy(*k, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    near = (join_null_safe(binned, placed, [*k, "bin"])
            .withColumn("end", F.col("before") + F.sum("c").over(w2)).withColumn("start", F.col("end") - F.col("c")))
    pick = lambda r: F.max(F.when((F.col(r) >= F.col("start")) & (F.col(r) < F.col("end")), F.col("v")))
    return (near.groupBy(*k).agg(pick("lo").alias("vlo"), pick("hi").alias("vhi"), F.max(F.col("at") - F.col("lo")).alias("frac"))
            .select(*k, (F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")).alias(name)))
