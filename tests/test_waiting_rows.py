"""Rows that wait for the watermark, kept in pieces: what a timer hands on, reads and leaves."""

import random

import pandas as pd

from tablestream.streaming import stateful as ST


class Pieces:
    """A map state in memory that counts the rows read and written."""

    def __init__(self):
        self.held, self.read, self.wrote = {}, 0, 0

    def containsKey(self, key):
        return key in self.held

    def updateValue(self, key, value):
        self.held[key] = value
        self.wrote += len(value[0])

    def getValue(self, key):
        self.read += len(self.held[key][0])
        return self.held[key]

    def removeKey(self, key):
        del self.held[key]

    def keys(self):
        return iter(list(self.held))


class Handle:
    def __init__(self):
        self.pieces, self.timers = Pieces(), []

    def getMapState(self, *_):
        return self.pieces

    def getListState(self, *_):
        return None

    def registerTimer(self, ms):
        self.timers.append(ms)


def holder():
    handle = Handle()
    held = ST.OrderedRows(["k"])
    held.init(handle)
    return held, handle


def feed(held, rows):
    list(held.handleInputRows(("x",), iter([pd.DataFrame(rows, columns=["row_us", "row_id", "row_label", "row_value"])]), None))


def test_rows_come_once_in_order_whatever_the_order_of_arrival():
    rng = random.Random(5)
    held, handle = holder()
    sent, got, mark = [], [], 0
    for _ in range(40):
        rows = [(mark + rng.randrange(1, 900), str(rng.randrange(50)) if rng.random() < 0.9 else None, None, rng.choice([None, 1.5])) for _ in range(rng.choice([0, 1, 3, 400, 5000]))]
        sent += rows
        feed(held, rows)
        if rows:
            assert handle.timers[-1] == min(r[0] for r in rows) // 1000 + 1
        before, mark = mark, mark + rng.randrange(300)
        ready, later = held.reached(mark)
        assert ready == sorted(ready, key=ST.in_order) and all(before < r[0] <= mark for r in ready)
        got += ready
        assert later == min((r[0] for r in sent if r[0] > mark), default=None)
    ready, later = held.reached(mark + 1000)
    assert later is None and not handle.pieces.held
    full = lambda r: (ST.in_order(r), r[3] is not None)              # noqa: E731
    assert sorted(got + ready, key=full) == sorted(sent, key=full)


def test_a_timer_reads_what_is_due_and_no_more_than_a_piece_beyond():
    held, handle = holder()
    feed(held, [(i, str(i), None, 1.0) for i in range(100_000)])
    handle.pieces.wrote = 0
    for mark in range(999, 100_000, 1000):
        ready, _ = held.reached(mark)
        assert len(ready) == 1000
    assert handle.pieces.read <= 100_000 + 100 * ST.MOST_ROWS and handle.pieces.wrote <= 100 * ST.MOST_ROWS
    assert not handle.pieces.held


def in_calls(held, rows, sizes):
    """Rows handed on in several calls, with what each call carries on to the next."""
    out, old, at = [], [], 0
    for n in sizes:
        more, old = held.process(("x",), rows[at:at + n], old)
        out, at = out + more, at + n
    return out


def test_last_rows_against_plain_windows():
    rng = random.Random(7)
    rows = [(i, str(i), None, rng.choice([None, float(rng.randrange(9))])) for i in range(120)]
    for n in (0, 1, 7, 200):
        want = []
        for i, (us, row_id, _, _) in enumerate(rows):
            near = rows[max(i - n, 0):i + 1]
            values = [r[3] for r in near if r[3] is not None]
            want.append((row_id, us, len(near), min(values, default=None), max(values, default=None)))
        for sizes in ([120], [1, 0, 2, 40, 0, 77], [1] * 120):
            assert in_calls(ST.LastRows(["k"], n), rows, sizes) == want


def test_only_the_first_row_of_a_key():
    rows = [(5, "b", None, None), (5, "c", None, None), (9, None, None, None)]
    for sizes in ([3], [0, 1, 2], [1, 1, 0, 1]):
        assert in_calls(ST.KeepFirst(["k"]), rows, sizes) == [("b", 5)]
