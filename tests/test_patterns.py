"""Pattern automaton against enumeration; sequential scans with cut keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablestream.operators import patterns as X

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)
FAR = 10**9


def plan(*stages):
    return [(how, lo, hi, optional, greedy) for how, lo, hi, optional, greedy in stages]


def run(text, letters, stages, within=FAR, until=None):
    flags = [[c in l for c in text] for l in letters]
    stops = [[bool(until and until[i]) and c in until[i] for c in text] for i in range(len(letters))]
    out = []
    for s in range(len(text)):
        out += ["".join(f"{text[r]}{r}" for _, r in m) for m in X.find_sequences(flags, stops, list(range(len(text))), stages, s, within)]
    return sorted(out)


def enumerate_all(text, letters, hows, within):
    """Every increasing index tuple, one row per stage, that keeps the contiguity rules."""
    out = []
    for idx in itertools.combinations(range(len(text)), len(letters)):
        ok = all(text[i] in l for i, l in zip(idx, letters)) and idx[-1] - idx[0] <= within
        for j in range(1, len(idx)):
            between = range(idx[j - 1] + 1, idx[j])
            if hows[j] == "next":
                ok = ok and idx[j] == idx[j - 1] + 1
            elif hows[j] == "followed_by":
                ok = ok and not any(text[b] in letters[j] for b in between)
        if ok:
            out.append("".join(f"{text[i]}{i}" for i in idx))
    return sorted(out)


@pytest.mark.parametrize("seed", range(30))
def test_single_rows_match_enumeration(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice("abcd") for _ in range(9))
    hows = ["followed_by"] + [rnd.choice(["next", "followed_by", "followed_by_any"]) for _ in range(2)]
    within = rnd.choice([3, 5, FAR])
    assert run(text, "abc", plan(*[(h, 1, 1, False, False) for h in hows]), within) == enumerate_all(text, "abc", hows, within)


def test_one_or_more_reports_each_length():
    stages = plan(("followed_by", 1, 1, False, False), ("followed_by", 1, None, False, False), ("followed_by", 1, 1, False, False))
    assert run("abdbc", "abc", stages) == ["a0b1b3c4", "a0b1c4"]


def test_greedy_takes_all_it_can():
    loop = lambda greedy: plan(("followed_by", 1, 1, False, False), ("followed_by", 1, None, False, greedy), ("followed_by", 1, 1, False, False))
    assert run("abbc", "abc", loop(True)) == ["a0b1b2c3"]
    # a row that fits both stages stays with the greedy loop
    assert run("abxc", ["a", "bx", "xc"], loop(True)) == ["a0b1x2c3"]
    assert run("abxc", ["a", "bx", "xc"], loop(False)) == ["a0b1x2", "a0b1x2c3"]


def test_times_optional_until():
    assert run("abbbc", "abc", plan(("followed_by", 1, 1, False, False), ("followed_by", 2, 2, False, False), ("followed_by", 1, 1, False, False))) == ["a0b1b2c4"]
    opt = plan(("followed_by", 1, 1, False, False), ("next", 1, 1, True, False), ("next", 1, 1, False, False))
    assert run("acabc", "abc", opt) == ["a0c1", "a2b3c4"]
    stages = plan(("followed_by", 1, 1, False, False), ("followed_by", 1, None, False, False))
    assert run("abxb", "ab", stages, until=[None, "x"]) == ["a0b1"]
    assert run("abxb", "ab", stages) == ["a0b1", "a0b1b3"]


def events(spark, seed, n=60):
    rnd = random.Random(seed)
    data = [(rnd.choice("uvw"), T0 + dt.timedelta(minutes=i), rnd.choice("abcx"), rnd.uniform(0, 30), i) for i in range(n)]
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "k string, at timestamp, kind string, v double, id int").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cut", [False, True])
def test_match_sequence_over_cut_keys(spark, seed, cut, request):
    if cut:
        request.getfixturevalue("hot")
    data, d = events(spark, seed)
    k = F.col("kind")
    stages = [X.Stage("a", k == "a"), X.Stage("b", k == "b", "followed_by", 1, None), X.Stage("c", k == "c", "followed_by_any")]
    got = rows(X.match_sequence(d, "k", "at", stages, "15 minutes", id_col="id"), "k", "matched")
    want = []
    for key in "uvw":
        mine = sorted(r for r in data if r[0] == key)
        mine = sorted(mine, key=lambda r: r[1])
        flags = [[r[2] == c for r in mine] for c in "abc"]
        us = [int((r[1] - T0).total_seconds() * 1e6) for r in mine]
        for s in range(len(mine)):
            for m in X.find_sequences(flags, [[False] * len(mine)] * 3, us, plan(("followed_by", 1, 1, False, False), ("followed_by", 1, None, False, False), ("followed_by_any", 1, 1, False, False)), s, 15 * 60 * 10**6):
                want.append((key, [f"{'abc'[st]}:{mine[r][4]}" for st, r in m]))
    assert sorted(map(str, got)) == sorted(map(str, want)) and want


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("cut", [False, True])
def test_match_runs_over_cut_keys(spark, seed, cut, request):
    if cut:
        request.getfixturevalue("hot")
    data, d = events(spark, seed, 40)
    want = []
    for key in "uvw":
        s, n, first, last = 0.0, 0, None, None
        for r in sorted((r for r in data if r[0] == key), key=lambda r: r[1]):
            if (s + r[3]) / (n + 1) < 15:
                first, last, s, n = first or r[1], r[1], s + r[3], n + 1
            elif n:
                want.append((key, first, last, round(s / n, 9), n))
                s, n, first = 0.0, 0, None
    got = [(k, a, b, round(v, 9), n) for k, a, b, v, n in rows(X.match_runs(d, "k", "at", "v", 15.0))]
    assert sorted(got) == sorted(want) and want
