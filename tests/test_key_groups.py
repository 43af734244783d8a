"""Processors of one key run for groups of keys: the same rows as key by key, with calls to the state store by the group."""

import datetime as dt
import random

import pandas as pd
import pytest

from tablestream.streaming import sequences as SQ, stateful as ST, streams as S

from .conftest import rows as collected
from .test_stream_sequences import Clock, drive, line


class Store:
    """State of a group in memory that counts calls."""

    def __init__(self, handle):
        self.handle, self.v = handle, None

    def get(self):
        self.handle.calls += 1
        return self.v

    def update(self, v):
        self.handle.calls += 1
        self.v = v

    def clear(self):
        self.handle.calls += 1
        self.v = None

    def containsKey(self, k):
        self.handle.calls += 1
        return k in (self.v or {})

    def getValue(self, k):
        self.handle.calls += 1
        return self.v[k]

    def updateValue(self, k, v):
        self.handle.calls += 1
        self.v = {**(self.v or {}), k: v}

    def removeKey(self, k):
        self.handle.calls += 1
        del self.v[k]

    def keys(self):
        self.handle.calls += 1
        return list(self.v or {})


class Handle:
    def __init__(self):
        self.calls, self.states, self.timers = 0, {}, set()

    def state(self, name, *_):
        return self.states.setdefault(name, Store(self))

    getValueState = getListState = getMapState = state

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)


def drive_group(group, per_key, batches=6, delay=2_000_000, **more):
    """Rows of many keys through one group, by time of arrival; what each key gave, the most calls a batch made, and the states."""
    rng, h = random.Random(1), Handle()
    group.init(h)
    arrive = sorted(((k, *r) for k, mine in per_key.items() for r in mine), key=lambda x: x[1] + rng.random() * delay)
    out, high, most, size = {}, 0, 0, -(-len(arrive) // batches)

    def note(frames):
        for d in frames:
            for k, *rest in d.astype(object).where(d.notna(), None).itertuples(index=False):
                out.setdefault(k, []).append(tuple(rest))

    def fire(mark):
        due = {t for t in h.timers if t <= mark}
        assert len(h.timers) <= 1
        for _ in due:
            note(group.handleExpiredTimer((0,), Clock(mark), None))
        h.timers -= due

    for i in range(0, len(arrive), size):
        part, h.calls = arrive[i:i + size], 0
        frame = pd.DataFrame(part, columns=[ST.KEY, "row_us", "row_id", "row_label", "row_value"]).assign(**{k: [f(x) for x in part] for k, f in more.items()})
        note(group.handleInputRows((0,), iter([frame]), Clock(0)))
        high = max(high, max(x[1] for x in part))
        fire((high - delay) // 1000)
        most = max(most, h.calls)
    while h.timers:
        fire(10**13)
    return out, most, h.states


ORDERED = {
    "lag": lambda k: ST.Lag(k), "locf": lambda k: ST.CarryForward(k), "total": lambda k: ST.RunningTotal(k), "range": lambda k: ST.RangeOver(k, 5_000_000),
    "crossing": lambda k: ST.Crossing(k, 5_000_000, 30.0, 3), "change": lambda k: ST.OnChange(k), "count": lambda k: ST.CountWindow(k, 4),
    "ttl": lambda k: ST.ForgetfulDedup(k, 1_000_000), "first": lambda k: ST.KeepFirst(k), "last rows": lambda k: ST.LastRows(k, 3),
    "bands": lambda k: SQ.Bands(k, 1.96, 5), "cutoffs": lambda k: SQ.Cutoffs(k, 7_000_000, 0, 1_000_000, 9_000_000), "runs": lambda k: SQ.RunMatch(k, 7.0),
}


@pytest.mark.parametrize("name", ORDERED)
def test_a_group_gives_what_its_keys_give(name):
    per_key = {f"k{n}": line(40, n) for n in range(12)}
    got, _, _ = drive_group(ST.OrderedGroups(ORDERED[name]([ST.KEY])), per_key)
    for k, mine in per_key.items():
        want, _ = drive(ORDERED[name], mine)
        assert sorted(got.get(k, []), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("make", [lambda: ST.OrderedGroups(ST.ForgetfulDedup([ST.KEY], 10**9)), lambda: ST.Groups(SQ.RunningTop([ST.KEY], 3)), lambda: ST.Groups(ST.Counter([ST.KEY]))])
def test_calls_to_the_state_store_do_not_grow_with_the_keys(make):
    for n in (20, 2000):
        _, most, _ = drive_group(make(), {f"k{i}": line(6, i) for i in range(n)})
        assert most < 150


def test_running_top_upserts_and_counts_of_a_group():
    per_key = {f"k{n}": line(30, n) for n in range(8)}
    got, _, _ = drive_group(ST.Groups(SQ.RunningTop([ST.KEY], 3)), per_key)
    for k, mine in per_key.items():
        live = {}
        for kind, i, v, _ in got[k]:
            live[i, v] = live.get((i, v), 0) + (1 if kind == "+I" else -1)
        best = sorted([(v, int(i)) for _, i, _, v in mine if v is not None], reverse=True)[:3]
        assert sorted((v, int(i)) for (i, v), n in live.items() if n) == sorted(best)
    got, _, _ = drive_group(ST.Groups(ST.Counter([ST.KEY])), per_key)
    assert {k: v[-1] for k, v in got.items()} == {k: (30,) for k in per_key}
    kinds = {f"k{n}": [(us, i, "-D" if j == 29 else "+U", None) for j, (us, i, _, _) in enumerate(line(30, n))] for n in range(8)}
    big = 2**60
    got, _, states = drive_group(ST.Groups(SQ.UpsertLog([ST.KEY], 10**9)), kinds, seq=lambda x: str(big + int(x[2])))
    assert all(g[-1][0] == "-D" and g[-1][2] == big + 29 for g in got.values()) and states["memory"].v is None


def test_keys_of_any_type_come_back_as_they_were(spark, tmp_path):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    data = [(2**60 + 1, "x\"{", at, 1.5), (2**60 + 1, "x\"{", at, 1.5), (None, None, None, None), (7, "", at, 0.1), (None, "y", at, None)]
    schema, keys = "k bigint, s string, t timestamp, d double", ["k", "s", "t", "d"]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    S.run_stream(ST.stream_counter(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), keys), f"{tmp_path}/out", f"{tmp_path}/chk", "update", keys)
    got = collected(spark.read.parquet(f"{tmp_path}/out"), *keys, "n")
    assert len(got) == 4 and set(got) == {(*x, data.count(x)) for x in data}
