"""Registry of queries over the analytics tables, each with the SQL an independent engine can check it with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import tune


class Tables:
    """Lazy access to the parquet tables of one data folder: ``t.events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    doc: str

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(tune(spark), folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it has no relational check and is covered by fixture tests."""
    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql.strip() if sql else None, (fn.__doc__ or "").strip())
        return fn
    return wrap


def load_all() -> dict[str, Query]:
    from . import (q_aggregates, q_changelog, q_dedup, q_features, q_functions, q_joins, q_nested, q_over, q_patterns,  # noqa: F401
                   q_quality, q_relational, q_sinks, q_sources, q_streaming, q_windows)
    return QUERIES
