"""Stream processors against plain Python: each is fed in batches with a watermark and timers, without a session."""

import random
from collections import defaultdict

import pandas as pd
import pytest

from tablestream.operators import patterns as X
from tablestream.streaming import sequences as SQ, stateful as ST

from .conftest import rows as collected


class State:
    """List, value or map state in memory."""

    def __init__(self):
        self.v = None

    def exists(self):
        return bool(self.v)

    def get(self):
        return list(self.v or ()) if not isinstance(self.v, tuple) else self.v

    def put(self, v):
        self.v = list(v)

    def appendList(self, v):
        self.v = (self.v or []) + list(v)

    def update(self, v):
        self.v = tuple(v)

    def clear(self):
        self.v = None

    def containsKey(self, k):
        return k in (self.v or {})

    def getValue(self, k):
        return self.v[k]

    def updateValue(self, k, v):
        self.v = {**(self.v or {}), k: v}

    def removeKey(self, k):
        del self.v[k]

    def keys(self):
        return list(self.v or {})

    def iterator(self):
        return list((self.v or {}).items())


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def _state(self, name, *_):
        return self.states.setdefault(name, State())

    getListState = getValueState = getMapState = _state

    def registerTimer(self, ms):
        self.timers.add(ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def drive(make, rows, batches=6, delay=2_000_000, seed=0, **more):
    """Run a processor over (us, id, label, value) rows of one key that arrive up to ``delay`` late; what it gave, and its states."""
    r = random.Random(seed)
    p, h = make(["k"]), Handle()
    p.init(h)
    arrive = sorted(rows, key=lambda x: x[0] + r.random() * delay)
    out, high = [], 0

    def fire(mark):
        due = sorted(x for x in h.timers if x <= mark)
        h.timers -= set(due)
        for _ in due:
            for d in p.handleExpiredTimer(("k",), Clock(mark), None):
                out.extend(tuple(x)[1:] for x in d.astype(object).where(d.notna(), None).itertuples(index=False))
    size = -(-len(arrive) // batches)
    for i in range(0, len(arrive), size):
        part = arrive[i:i + size]
        frame = pd.DataFrame(part, columns=["row_us", "row_id", "row_label", "row_value"]).assign(**{k: [f(x) for x in part] for k, f in more.items()})
        for d in p.handleInputRows(("k",), iter([frame]), Clock(0)):
            out.extend(tuple(x)[1:] for x in d.astype(object).where(d.notna(), None).itertuples(index=False))
        high = max(high, max(x[0] for x in part))
        fire((high - delay) // 1000)
    while h.timers:
        fire(10**13)
    return out, h.states


def line(n=80, seed=0, step=1_500_000):
    r, us, out = random.Random(seed), 10_000_000, []
    for i in range(n):
        us += r.randrange(1, step)
        out.append((us, str(i), r.choice("abc"), float(r.randrange(20)) if r.random() < 0.9 else None))
    return out


PATTERNS = {
    "relaxed": [X.Stage("a", "a"), X.Stage("b", "b"), X.Stage("c", "c", "followed_by_any")],
    "strict": [X.Stage("a", "a"), X.Stage("b", "b", "next"), X.Stage("c", "c", "next", optional=True)],
    "loop": [X.Stage("a", "a"), X.Stage("b", "b", at_least=1, at_most=3), X.Stage("c", "c")],
    "greedy end": [X.Stage("a", "a"), X.Stage("b", "b", at_least=2, at_most=None, greedy=True, until="c")],
    "greedy middle": [X.Stage("a", "a", at_most=2), X.Stage("b", "b", at_least=1, at_most=None, greedy=True), X.Stage("c", "abc", "followed_by_any")],
    "optional head": [X.Stage("a", "a", optional=True), X.Stage("b", "b"), X.Stage("c", "c", "next", optional=True)],
    "dearer": [X.Stage("a", "a"), X.Stage("b", "b", "followed_by_any", relative=(">", "a", "first"))],
    "rising": [X.Stage("a", "abc"), X.Stage("b", "abc", at_most=4, relative=(">", "b", "last")), X.Stage("c", "c", relative=("<=", "a", "last"))],
}


@pytest.mark.parametrize("name", PATTERNS)
def test_sequences_match_the_batch_search(name):
    """Every pattern in a stream gives the matches of the search that sees all rows, and leaves no state."""
    stages, within = PATTERNS[name], 6_000_000
    plan = [(s.contiguity, s.at_least, s.at_most, s.optional, s.greedy) for s in stages]
    for seed in range(12):
        rows = line(60, seed)
        flags = [[r[2] in s.where for r in rows] for s in stages]
        stops = [[s.until is not None and r[2] in s.until for r in rows] for s in stages]
        times, values = [r[0] for r in rows], [r[3] for r in rows]
        want = []
        for start in range(len(rows)):
            for m in X.find_sequences(flags, stops, times, plan, start, within, values, X.relations(stages)):
                want.append((times[m[0][1]], times[m[-1][1]], ">".join(f"{stages[s].name}:{rows[i][1]}" for s, i in m)))
        coded = [(us, i, "".join("1" if f[n] else "0" for f in flags) + "".join("1" if f[n] else "0" for f in stops), v) for n, (us, i, _, v) in enumerate(rows)]
        got, states = drive(lambda k: SQ.SequenceMatch(k, stages, within), coded, seed=seed)
        assert sorted(got) == sorted(want) and (want or name == "strict")
        assert not any(s.exists() for s in states.values())


def test_relative_conditions_of_null_and_missing_rows():
    assert X.holds(None, None, iter(())) and X.holds((">", 0, "first"), None, iter(()))
    assert not X.holds((">", 0, "first"), None, iter([(0, 1.0)])) and not X.holds((">", 0, "first"), 1.0, iter([(0, None)]))
    assert X.holds((">", 0, "first"), 2.0, iter([(0, 5.0), (1, 9.0), (0, 1.0)])) and not X.holds((">", 0, "last"), 2.0, iter([(0, 5.0), (0, 1.0)]))


def test_runs_and_bands():
    for seed in range(5):
        rows = line(80, seed)
        got, states = drive(lambda k: SQ.RunMatch(k, 7.0), rows, seed=seed)
        want, run = [], []
        for us, _, _, v in rows:
            if v is None:
                continue
            if (sum(x for _, x in run) + v) / (len(run) + 1) < 7:
                run.append((us, v))
            else:
                if run:
                    want.append((run[0][0], run[-1][0], sum(x for _, x in run) / len(run), len(run)))
                run = []
        assert got == want and want
        got, _ = drive(lambda k: SQ.Bands(k, 1.96, 10), rows, seed=seed)
        for (us, i, _, v), (gi, gus, gv, mean, low, high, flag) in zip(rows, got):
            past = [x[3] for x in rows if x[0] < us and x[3] is not None]
            assert (gi, gus, gv) == (i, us, v)
            if len(past) < 10:
                assert mean is None and not flag
            else:
                m = sum(past) / len(past)
                sd = (sum((x - m) ** 2 for x in past) / (len(past) - 1)) ** 0.5
                assert mean == pytest.approx(m) and high == pytest.approx(m + 1.96 * sd) and flag == (v is not None and abs(v - m) > 1.96 * sd)


def fold(changes, keys):
    live = defaultdict(int)
    for c in changes:
        live[tuple(c[i] for i in keys)] += -1 if c[0] in ("-D", "-U") else 1
    assert set(live.values()) <= {0, 1}
    return {k for k, n in live.items() if n}


def test_join_with_a_time_to_live_for_each_side():
    for outer in (False, True):
        for seed in range(6):
            rows = [(us, i, "l" if label == "a" else "r", None) for us, i, label, _ in line(80, seed)]
            got, states = drive(lambda k: SQ.JoinTtl(k, 1_000_000, 3_000_000, outer), rows, seed=seed)
            left, right = [r for r in rows if r[2] == "l"], [r for r in rows if r[2] == "r"]
            want = {(a[1], b[1]) for a in left for b in right if -3_000_000 <= b[0] - a[0] <= 1_000_000}
            met = {a for a, _ in want}
            assert fold(got, (1, 2)) == want | ({(a[1], None) for a in left if a[1] not in met} if outer else set())
            assert not any(s.exists() for s in states.values())


def test_upsert_join_re_prices_its_own_facts():
    for seed in range(6):
        r = random.Random(seed)
        rows = []
        for us, i, label, _ in line(80, seed):
            kind = r.choice(["d", "fa", "fb", "fc", "xa", "xb"])
            rows.append((us, i if kind[0] != "x" else None, kind, None))
        got, _ = drive(SQ.UpsertJoin, rows, seed=seed)
        facts, dim = {}, None
        for _, i, kind, _ in rows:
            if kind == "d":
                dim = i
            elif kind[0] == "x":
                facts.pop(kind[1:], None)
            else:
                facts[kind[1:]] = i
        assert [c[5] for c in got] == list(range(1, len(got) + 1))
        assert fold(got, (1, 2, 3)) == {(k, f, dim) for k, f in facts.items()}


def test_growing_windows():
    for seed in range(6):
        rows = [(us * 3000, i, label, v) for us, i, label, v in line(60, seed)]
        step, size = 3_600_000_000, 4 * 3_600_000_000
        got, states = drive(lambda k: SQ.Growing(k, step, size), rows, seed=seed, delay=1_800_000_000)
        want = {}
        for us, _, _, v in rows:
            start = us // size * size
            for end in range((us // step + 1) * step, start + size + 1, step):
                n, total = want.get((start, end), (0, None))
                want[start, end] = (n + 1, total if v is None else v + (total or 0.0))
        assert sorted(got) == sorted((a, z, n, t) for (a, z), (n, t) in want.items()) and len(got) == len(want)
        assert not any(s.exists() for s in states.values())


def test_running_top_takes_displaced_rows_back():
    for seed in range(6):
        rows = line(80, seed)
        got, states = drive(lambda k: SQ.RunningTop(k, 3), rows, seed=seed)
        want = sorted([(v, int(i)) for _, i, _, v in rows if v is not None], reverse=True)[:3]
        assert fold(got, (1, 2)) == {(str(i), v) for v, i in want} and len(states["best"].v) == 3


def test_upserts_out_of_order_and_tombstones():
    for seed in range(8):
        r = random.Random(seed)
        rows = [(us, i, r.choice(["+U", "+U", "-U", "-D"]), None) for us, i, _, _ in line(40, seed)]
        number = {i: n for n, (_, i, _, _) in enumerate(r.sample(rows, len(rows)))}
        got, states = drive(lambda k: SQ.UpsertLog(k, 10**9), rows, seed=seed, seq=lambda x: number[x[1]])
        kind, last = max(((x[2], x[1]) for x in rows if x[2] != "-U"), key=lambda x: number[x[1]])
        assert fold(got, (1,)) == (set() if kind == "-D" else {(last,)})
        assert states["now"].exists() == (kind != "-D")      # a tombstone goes when no older row can come


def test_cutoffs_of_silent_keys():
    hour = 3_600_000_000
    for seed in range(8):
        rows = [(us * 6000, i, None, None) for us, i, _, _ in line(40, seed)]
        got, states = drive(lambda k: SQ.Cutoffs(k, 12 * hour, hour // 2, 2 * hour, 24 * hour), rows, seed=seed, delay=hour)
        want = []
        for at in range(hour // 2, rows[-1][0] + 30 * hour, 12 * hour):
            last = max((r for r in rows if r[0] <= at), default=None)
            if last is not None and 2 * hour <= at - last[0] <= 24 * hour:
                want.append((last[1], at))
        assert sorted(got) == sorted(want) and want
        assert not any(s.exists() for s in states.values())


def test_time_to_live_lets_silent_keys_go():
    rows = line(30, 3)
    got, states = drive(lambda k: ST.ForgetfulDedup(k, 1_000_000), rows)
    want = [(i, us) for n, (us, i, _, _) in enumerate(rows) if n == 0 or us - rows[n - 1][0] > 1_000_000]
    assert got == want and not any(s.exists() for s in states.values())
    got, states = drive(lambda k: ST.PairOnce(k, 1_000_000), [(us, i, "l" if label == "a" else "r", None) for us, i, label, _ in rows])
    assert got and not any(s.exists() for s in states.values())


def test_a_machine_that_never_resets_is_written_twice(spark, monkeypatch):
    """A run over more than 100 chunks: one speculative run and one walk, the sequential result."""
    values = [(k, i, float(v)) for k, n in (("x", 1200), ("y", 1200), ("z", 3)) for i, v in enumerate([1.0] * (n - 1) + [1e9 if k != "y" else 1.0])]
    values += [("w", i, 1.0 if i % 40 else 1e6) for i in range(1200)]
    d = spark.createDataFrame(values, "k string, i int, v double").selectExpr("k", "i", "v", "timestamp_seconds(1000000 + i) as at")
    writes = []
    plain = X.cut_lineage
    monkeypatch.setattr(X, "cut_lineage", lambda df: writes.append(1) or plain(df))
    spark.conf.set("spark.tablestream.hotKeyRows", "100")
    try:
        got = collected(X.match_runs(d, "k", "at", "v", 5.0, "i").select("k", "n"))
    finally:
        spark.conf.unset("spark.tablestream.hotKeyRows")
    assert got == sorted([("x", 1199), ("z", 2)] + [("w", 39)] * 29, key=str) and len(writes) <= 3
