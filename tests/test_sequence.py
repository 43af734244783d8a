"""Ordered operators against plain Python, with plain and with cut keys, on rows with ties and NULLs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablestream.operators import aggs as A, dedup as DD, features as M, over as O, sequence as Q, temporal as T, windows as W

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(params=[False, True], ids=["plain", "cut"])
def cut(request, spark):
    if request.param:
        spark.conf.set("spark.tablestream.hotKeyRows", "3")
    yield request.param
    spark.conf.unset("spark.tablestream.hotKeyRows")


def data(seed, n=80):
    """A key with a third of the rows, a NULL key, equal times, NULL values."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])
        at = T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 600), rnd.randrange(0, 40) * 15]))
        out.append((i, key, at, None if rnd.random() < 0.2 else rnd.randrange(100)))
    rnd.shuffle(out)
    return out


def frame(spark, d):
    return spark.createDataFrame(d, "id int, k string, at timestamp, v int").repartition(6)


def lines(d):
    by = {}
    for r in d:
        by.setdefault(r[1], []).append(r)
    return {k: sorted(v, key=lambda r: (r[2], r[0])) for k, v in by.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_running_lag_locf_position(spark, cut, seed):
    d = data(seed)
    f = frame(spark, d)
    o = ["at", "id"]
    lag = dict(rows(O.lag(f, "k", o, "v", "p"), "id", "p"))
    total = dict(rows(O.running_total(f, "k", o, "v"), "id", "running_total"))
    carried = dict(rows(O.locf(f, "k", o, "v"), "id", "v"))
    place = dict(rows(O.row_number(f, "k", o), "id", "rn"))
    lead = dict(rows(T.versions(f, "k", "at"), "id", "valid_to"))
    change = {r[0] for r in rows(O.on_change(f, "k", o, "v"), "id")}
    for line in lines(d).values():
        s, last, prev = None, None, None
        for i, r in enumerate(line):
            assert lag[r[0]] == (line[i - 1][3] if i else None)
            s = r[3] if s is None else s + (r[3] or 0)
            last = r[3] if r[3] is not None else last
            assert (total[r[0]], carried[r[0]], place[r[0]]) == (s, last, i + 1)
            prev = line[i - 1][3] if i else None
            assert (r[0] in change) == (prev is None or (r[3] is not None and r[3] != prev))
        times = [r[2] for r in line]
        for i, r in enumerate(line):
            later = sorted(times[:i] + times[i + 1:])
            nxt = [t for t in times if t > r[2]]
            if times.count(r[2]) == 1:
                assert lead[r[0]] == (min(nxt) if nxt else None)


@pytest.mark.parametrize("seed", [4, 5])
def test_over_range_and_rows(spark, cut, seed):
    d = data(seed)
    f = frame(spark, d)
    rng = {i: (n, t) for i, n, t in rows(O.over_range(f, "k", "at", "45 seconds", {"n": ("count", "*"), "t": ("sum", "v")}), "id", "n", "t")}
    rws = {i: (n, m) for i, n, m in rows(O.over_rows(f, "k", ["at", "id"], 4, {"n": F.count(F.lit(1)), "m": F.max("v")}, block=7), "id", "n", "m")}
    for line in lines(d).values():
        for i, r in enumerate(line):
            near = [x for x in line if r[2] - dt.timedelta(seconds=45) <= x[2] <= r[2]]
            vals = [x[3] for x in near if x[3] is not None]
            assert rng[r[0]] == (len(near), sum(vals) if vals else None)
            block = line[max(0, i - 4):i + 1]
            vals = [x[3] for x in block if x[3] is not None]
            assert rws[r[0]] == (len(block), max(vals) if vals else None)


@pytest.mark.parametrize("seed", [6, 7])
def test_sessions(spark, cut, seed):
    d = data(seed, 50)
    got = rows(W.session(frame(spark, d), "at", "20 seconds", "k", {"n": ("count", "*"), "s": ("sum", "v"), "m": ("avg", "v")}), "k", "window_start", "window_end", "n", "s")
    want = []
    for k, line in lines(d).items():
        cur = []
        for r in [*line, None]:
            if cur and (r is None or r[2] - cur[-1][2] > dt.timedelta(seconds=20)):
                vals = [x[3] for x in cur if x[3] is not None]
                want.append((k, cur[0][2], cur[-1][2] + dt.timedelta(seconds=20), len(cur), sum(vals) if vals else None))
                cur = []
            cur.append(r)
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("seed", [8, 9])
def test_asof_interval_and_followup(spark, cut, seed):
    d = data(seed)
    f = frame(spark, d)
    l = f.filter("id % 2 = 0")
    r = f.filter("id % 2 = 1").select("k", F.col("at").alias("rt"), F.col("id").alias("rid"))
    asof = dict(rows(T.join_asof(l, r, "k", "at", "rt", ttl="2 minutes"), "id", "rid"))
    pairs = set(rows(T.join_interval(l, r, "k", "at", "rt", "-30 seconds", "10 seconds"), "id", "rid"))
    outer = rows(T.join_interval(l, r, "k", "at", "rt", "-30 seconds", "10 seconds", "left"), "id", "rid")
    silent = {x[0] for x in rows(T.missing_followup(f, "k", "at", F.col("id") % 2 == 0, F.col("id") % 2 == 1, "30 seconds"), "id")}
    sec = lambda n: dt.timedelta(seconds=n)
    want = set()
    for a in (x for x in d if x[0] % 2 == 0):
        rights = [x for x in d if x[0] % 2 == 1 and x[1] == a[1] and a[1] is not None]
        before = [x for x in rights if x[2] <= a[2]]
        best = max(before, key=lambda x: (x[2], x[0])) if before else None
        assert asof[a[0]] == (best[0] if best and a[2] - best[2] <= sec(120) else None)
        want |= {(a[0], x[0]) for x in rights if a[2] - sec(30) <= x[2] <= a[2] + sec(10)}
        assert (a[0] in silent) == (not any(a[2] <= x[2] <= a[2] + sec(30) for x in rights))
    assert pairs == want
    assert sorted(map(str, outer)) == sorted(map(str, [*want, *[(a[0], None) for a in d if a[0] % 2 == 0 and a[0] not in {p[0] for p in want}]]))


def test_time_can_be_null(spark, cut):
    f = spark.createDataFrame([(1, "a", None, 5), (2, "a", T0, 6), (3, "a", T0 + dt.timedelta(seconds=9), 7), (4, "a", None, 8)], "id int, k string, at timestamp, v int")
    assert rows(O.lag(f, "k", ["at", "id"], "v", "p"), "id", "p") == [(1, None), (2, 8), (3, 6), (4, 5)]
    assert W.session(f, "at", "5 seconds", "k", {"n": ("count", "*")}).count() == 2


def test_no_key_is_one_line(spark, cut):
    f = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=i), i) for i in range(30)], "id int, at timestamp, v int")
    assert dict(rows(O.running_total(f, [], "at", "v"), "id", "running_total"))[29] == sum(range(30))


def test_exact_quantile_and_mad(spark):
    rnd = random.Random(11)
    d = [("hot" if i % 3 else "b", rnd.choice([rnd.randrange(20), rnd.random() * 50])) for i in range(400)]
    f = spark.createDataFrame([(k, float(v)) for k, v in d], "k string, v double").repartition(5)
    import numpy as np
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = dict(rows(A.exact_quantile(f, "k", "v", p, "q")))
        for k in ("hot", "b"):
            assert got[k] == pytest.approx(np.quantile([v for kk, v in d if kk == k], p))


def test_anomaly_needs_training(spark, cut):
    d = [("s", T0 + dt.timedelta(seconds=i), 10.0 + (i % 3) if i != 40 else 500.0) for i in range(60)]
    f = spark.createDataFrame(d, "k string, at timestamp, v double")
    out = M.escalate(M.detect_anomalies(f, "k", "at", "v", 99.0, 30))
    assert rows(out, "v") == [(500.0,)]
    early = spark.createDataFrame([(k, t, 500.0 if i == 5 else v) for i, (k, t, v) in enumerate(d[:20])], "k string, at timestamp, v double")
    assert M.escalate(M.detect_anomalies(early, "k", "at", "v", 99.0, 30)).count() == 0


def test_two_phase_equals_plain(spark):
    f = frame(spark, data(12))
    aggs = {"n": ("count", "*"), "s": ("sum", "v"), "lo": ("min", "v"), "m": ("avg", "v"), "c": ("count_if", "v > 50")}
    assert rows(A.agg_two_phase(f, "k", aggs, "id", 5)) == rows(A.agg(f, "k", aggs))


def test_vector_topk_is_exact_for_any_blocking(spark):
    rnd = random.Random(13)
    base = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(120)]
    f = spark.createDataFrame(base, "id int, v array<double>")
    q = spark.createDataFrame(base[:7], "qid int, q array<double>")
    one = rows(M.vector_topk(q, f, 4, "qid", "id", "v", "q"), "qid", "rank", "id")
    assert one == rows(M.vector_topk(q, f, 4, "qid", "id", "v", "q", block_rows=25, slice_rows=3), "qid", "rank", "id")
    assert [r for r in one if r[1] == 1] == [(i, 1, i) for i in range(7)]


def test_grid_is_bounded(spark, cut):
    g = Q.grid_for(frame(spark, data(1)), ["k"], "at")
    assert g.count() == (4 if cut else 0)


def test_top_n_is_cut_before_the_shuffle(spark):
    plan = DD.dedup_last(frame(spark, data(1)), "k", ["at", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("hashpartitioning(k") < plan.index("Partial")


def test_hot_key_is_spread_over_chunks(spark):
    """A key with a third of 30,000 rows: no (key, chunk) group keeps more than a tenth of it."""
    f = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", (F.lit(T0) + F.make_dt_interval(secs=F.col("id").cast("int"))).alias("at"))
    spark.conf.set("spark.tablestream.hotKeyRows", "1000")
    try:
        c = Q.with_chunk(f, ["k"], "at")
        per = c.groupBy("k", Q.CHUNK).count()
        assert per.agg(F.max("count")).first()[0] <= 200 and c.filter(Q.HOT).select("k").distinct().count() == 1
        out = O.lag(f, "k", ["at", "id"], "id", "p").filter("k = 0")
        assert out.filter("p is null").count() == 1 and out.filter("id - p = 3").count() == 9_999
    finally:
        spark.conf.unset("spark.tablestream.hotKeyRows")


def test_wide_values_are_not_broadcast_by_hint(spark):
    f = spark.createDataFrame([(1, T0, "x", 1)], "k int, at timestamp, text string, n int")
    plan = lambda c: O.lag(f, "k", "at", c, "p")._jdf.queryExecution().logical().toString()
    assert plan("n").count("strategy=broadcast") == plan("text").count("strategy=broadcast") + 1


def test_wall_clock_order_survives_a_clock_change(spark):
    """Zone-less times keep their order and distance in a session zone that skips an hour."""
    f = spark.createDataFrame([(i, "a", f"2024-03-31 0{i}:30:00") for i in range(1, 5)], "id int, k string, t string").withColumn("at", F.col("t").cast("timestamp_ntz"))
    want = [(1, None), (2, 1), (3, 2), (4, 3)]
    assert rows(O.lag(f, "k", "at", "id", "p"), "id", "p") == want
    utc = rows(O.over_range(f, "k", "at", "1 hour", {"n": ("count", "*")}), "id", "n")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert rows(O.lag(f, "k", "at", "id", "p"), "id", "p") == want
        assert rows(O.over_range(f, "k", "at", "1 hour", {"n": ("count", "*")}), "id", "n") == utc == [(1, 1), (2, 2), (3, 2), (4, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
