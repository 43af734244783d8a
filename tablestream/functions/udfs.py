"""User function shapes: scalar, table, aggregate, table aggregate, external call."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Iterator, Tuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.core import Keys, as_list
from ..operators.dedup import top_n

# Tax percentage by location, risk and confidence of the delivery estimate.
TAX_PERCENT = {"USA": 10, "EU": 5}
DEFAULT_TAX = 0
ETA_RISK, ETA_CONFIDENCE = 0.5, 0.8


def scalar_function(fn: Callable[[pd.Series], pd.Series], returns: str):
    """Arrow-batched scalar function. Use a column expression where one exists."""
    return F.pandas_udf(fn, returns)


def aggregate_function(df: DataFrame, keys: Keys, fn: Callable[[pd.Series], float], col: str, name: str,
                       returns: str = "double") -> DataFrame:
    """N rows -> 1 value per key by a pandas function; the group's column must fit one task."""
    def agg(v: pd.Series) -> float:
        return fn(v)
    return df.groupBy(*as_list(keys)).agg(F.pandas_udf(agg, returns)(col).alias(name))


def accumulate(df: DataFrame, keys: Keys, parts: dict[str, Column], finish: Column, name: str) -> DataFrame:
    """Aggregate with an accumulator made of built-in aggregates (combines on the map side)."""
    k = as_list(keys)
    return df.groupBy(*k).agg(*[c.alias(n) for n, c in parts.items()]).select(*k, finish.alias(name))


def table_aggregate_top(df: DataFrame, keys: Keys, order_by, n: int) -> DataFrame:
    """N rows -> M rows: the running top n with its rank."""
    return top_n(df, keys, order_by, n, rank="rank")


def split_words(col: str, sep: str = " ") -> Column:
    """Table function (word, length) as an array of rows for ``join_lateral``."""
    words = F.filter(F.split(col, sep), lambda w: w != "")
    return F.transform(words, lambda w: F.struct(w.alias("word"), F.length(w).alias("length")))


def tax_by_location(location: str) -> Column:
    """Tax percentage of a place."""
    c = F.coalesce(*[F.when(F.col(location) == place, pct) for place, pct in TAX_PERCENT.items()], F.lit(DEFAULT_TAX))
    return F.when(F.col(location).isNotNull(), c)


def estimate_delivery(event_ts: str) -> Column:
    """ETA: a 2-hour window that starts one day after the event; fixed risk and confidence."""
    start = F.col(event_ts) + F.expr("INTERVAL 1 DAY")
    return F.struct(start.alias("eta_window_start"), (start + F.expr("INTERVAL 2 HOURS")).alias("eta_window_end"),
                    F.lit(ETA_RISK).alias("risk_score"), F.lit(ETA_CONFIDENCE).alias("confidence"))


def call_external(df: DataFrame, fn: Callable[[dict], dict], cols: Keys, schema: str, threads: int = 8) -> DataFrame:
    """One call per row by a thread pool per partition, batch by batch; ``fn`` gets and returns a dict."""
    c = as_list(cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in batches:
                got = list(pool.map(fn, pdf[c].to_dict("records")))
                yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(got)], axis=1)

    extra = _fields(schema)
    full = ", ".join([f"`{n}` {t}" for n, t in df.dtypes] + extra)
    return df.mapInPandas(run, full)


def _fields(schema: str) -> list[str]:
    return [p.strip() for p in schema.split(",")]


def predict(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series], cols: Keys, name: str = "prediction",
            returns: str = "double") -> DataFrame:
    """Batched model call; the model object travels with the function, no remote service."""
    c = as_list(cols)

    def run(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for b in batches:
            yield model(pd.concat(list(b), axis=1, keys=c))

    def run_one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield model(b.to_frame(c[0]))

    udf = F.pandas_udf(run if len(c) > 1 else run_one, returns)
    return df.withColumn(name, udf(*[F.col(x) for x in c]))


def register(spark: SparkSession, name: str, fn, returns: str):
    """Make a function callable by name in SQL."""
    return spark.udf.register(name, F.pandas_udf(fn, returns))
