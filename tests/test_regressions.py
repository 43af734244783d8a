"""Faults found in earlier rounds, each with the table that showed it."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tablestream.operators import aggs as A, changelog as C, features as M, joins as J, over as O, patterns as X, windows as W
from tablestream.streaming import streams as S

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
ORDER = ["at", "id"]


@pytest.fixture
def some_hot(spark):
    """Keys are hot and cut into a few chunks."""
    spark.conf.set("spark.tablestream.hotKeyRows", "19")
    yield
    spark.conf.unset("spark.tablestream.hotKeyRows")


def line(spark, n=60):
    """One key (and a NULL one) with a MAP column that Spark cannot hash."""
    d = [(i, "k" if i % 3 else None, T0 + dt.timedelta(seconds=i), float(1 + i // 2 % 5), {"a": i}) for i in range(n)]
    return spark.createDataFrame(d, "id int, k string, at timestamp, v double, m map<string,int>")


MAPPED = {
    "lag": lambda d: O.lag(d, "k", ORDER, "v", "p"),
    "locf": lambda d: O.locf(d, "k", ORDER, "v"),
    "running_total": lambda d: O.running_total(d, "k", ORDER, "v", "t"),
    "on_change": lambda d: O.on_change(d, "k", ORDER, "v"),
    "row_number": lambda d: O.row_number(d, "k", ORDER),
    "over_rows": lambda d: O.over_rows(d, "k", ORDER, 3, {"s": F.sum("v")}),
    "session": lambda d: W.session(d, "at", "2 seconds", "k", {"n": ("count", "*")}),
    "count_window": lambda d: W.count_window(d, "k", ORDER, 5, {"s": ("sum", "v")}),
    "to_retract": lambda d: C.to_retract(d, "k", ORDER),
    "repeat_purchase": lambda d: X.repeat_purchase(d, "k", ORDER, "v"),
    "repeat_within": lambda d: X.repeat_within(d, "k", "v", "at", "10 seconds", "id"),
    "flapping": lambda d: X.flapping(d, "k", ORDER, "v", 2, "10 seconds"),
    "diff_alert": lambda d: X.diff_alert(d, "k", ORDER, "v"),
    "split_late": lambda d: S.split_late_batch(d, "at", "id", "1 second"),
    "anomalies": lambda d: M.detect_anomalies(d, "k", ORDER, "v", 95.0, 3),
    "anomalies_rolling": lambda d: M.detect_anomalies_rolling(d, "k", ORDER, "v", 10, 95.0, 3),
    "salted": lambda d: J.join_salted(d, d.groupBy("k").count(), "k", 4, share=2),
}


@pytest.mark.parametrize("name", MAPPED)
def test_map_column(spark, some_hot, name):
    """A MAP column neither crashes an ordered operator nor changes what it gives."""
    d = line(spark)
    got, want = MAPPED[name](d), MAPPED[name](d.withColumn("m", F.lit(0)))
    same = [c for c in want.columns if c != "m" and not dict(want.dtypes)[c].startswith("map")]
    found = rows(got.select(*same))
    assert found and found == rows(want.select(*same))


def bands(values, z, least):
    out = []
    for i, v in enumerate(values):
        past = [x for x in values[:i] if x is not None]
        if len(past) < max(least, 2):
            out.append((None, None, False))
            continue
        m = math.fsum(past) / len(past)
        sd = math.sqrt(math.fsum((x - m) ** 2 for x in past) / (len(past) - 1))
        out.append((m, m + z * sd, v is not None and not m - z * sd <= v <= m + z * sd))
    return out


@pytest.mark.parametrize("limit", [None, "2", "15"])
def test_a_later_outlier_changes_no_earlier_band(spark, limit):
    """Bands know earlier values only: a last value of 1e12 leaves all rows before it as they were, in one piece or in chunks."""
    if limit:
        spark.conf.set("spark.tablestream.hotKeyRows", limit)
    try:
        calm = [float(1 + i % 5) if i % 7 else None for i in range(100)]
        values = calm + [1e12, 3.0]
        d = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, id int, v double")
        got = {r.id: r.anomaly for r in M.detect_anomalies(d, "k", "id", "v", 95.0, 10).collect()}
        for i, (mean, high, flag) in enumerate(bands(values, 1.96, 10)):
            assert got[i].is_anomaly == flag
            if mean is None:
                assert got[i].forecast_value is None
            else:
                assert got[i].forecast_value == pytest.approx(mean, rel=1e-9) and got[i].upper_bound == pytest.approx(high, rel=1e-9)
        assert got[100].is_anomaly and not any(got[i].is_anomaly for i in range(100))
        rolled = {r.id: r.anomaly for r in M.detect_anomalies_rolling(d, "k", "id", "v", 20, 95.0, 10).collect()}
        assert rolled[100].is_anomaly and rolled[100].upper_bound < 10 and not any(rolled[i].is_anomaly for i in range(100))
    finally:
        spark.conf.unset("spark.tablestream.hotKeyRows")


def test_distinct_per_window_leaves_null_ids_out(spark):
    d = spark.createDataFrame([(T0, "a", 1), (T0, "a", None), (T0, "a", 1), (T0, "b", None)], "at timestamp, k string, u int")
    got = W.tumble_distinct(d, "at", "1 hour", "k", "u", "n")
    assert rows(got.select("k", "n")) == [("a", 1), ("b", 0)]


def test_all_levels_write_pairs_of_groups_only(spark, monkeypatch):
    """Leaves come in after the doubling; with several parents, in cycles and below NULL they are met once by each root."""
    import random

    from tablestream.operators import joins as J
    rng, wrote = random.Random(3), []
    plain = J.cut_lineage
    monkeypatch.setattr(J, "cut_lineage", lambda df: wrote.append(df.count()) or plain(df))
    edges = {(f"g{i // 2}", f"g{i}", "GROUP") for i in range(1, 60)} | {("g7", "g1", "GROUP"), (None, "lost", "LEAF")}
    edges |= {(f"g{rng.randrange(80)}", f"o{i % 300}", "LEAF") for i in range(400)}
    d = spark.createDataFrame([*edges, *edges], "p string, c string, k string")
    want = set()
    for root in {p for p, _, _ in edges}:
        seen, todo = set(), [root]
        while todo:
            at = todo.pop()
            for p, c, k in edges:
                if p == at and k == "LEAF":
                    want.add((root, c))
                elif p == at and c not in seen:
                    seen.add(c)
                    todo.append(c)
    got = [tuple(r) for r in J.expand_hierarchy(d, "p", "c", "k", depth=None).collect()]
    assert len(got) == len(want) and set(got) == want
    assert sum(wrote) <= 60 * 60
