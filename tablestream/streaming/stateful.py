"""Per-key state: buffers, counters and timers for what the built-in streaming operators cannot express.

State stays small: rows wait only until the watermark passes them, and what is carried on is cut at the look-back or TTL.
Row ids, labels and values keep their NULLs.

Processors are written for one key and run for groups of keys (``with_groups``): a call to the state store costs far more than a row, so
a micro-batch makes some calls for each group it touches and none for each key.
"""

import pickle
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable
from typing import Any, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.core import Keys, all_of, as_list, seconds


def with_state(df: DataFrame, keys: Keys, processor: StatefulProcessor, schema: str, mode: str = "append", time: str = "None") -> DataFrame:
    """Run a user processor with state and timers per key (``time``: None, EventTime or ProcessingTime)."""
    return df.groupBy(*as_list(keys)).transformWithStateInPandas(processor, schema, mode, time)


def _ddl(df: DataFrame, cols: list[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"`{c}` {types[c]}" for c in cols)


def plain(r: pd.DataFrame, cols: list[str]) -> list[tuple]:
    """Rows of a frame as tuples of Python values, None for NULL."""
    return list(zip(*[r[c].astype(object).where(r[c].notna(), None).tolist() for c in cols]))


# ---- keys in groups ---------------------------------------------------------------------------------------

KEY, GROUP, GROUPS = "key_json", "key_group", 256              # no leading underscore: a frame's rows are named tuples
KEY_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class KeyProcessor(StatefulProcessor):
    """Base of processors of one key: ``take`` gets a batch's rows as tuples of ``columns``, ``fire`` runs when a timer is due; both return
    output rows without the key. It runs by itself (``with_state``) or for the keys of a group (``with_groups``).
    """
    columns: list[str] = []
    out_columns: list[str] = []

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def tuples(self, r: pd.DataFrame) -> list[tuple]:
        return plain(r, self.columns)

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        raise NotImplementedError

    def fire(self, key: tuple, mark_ms: int) -> list[tuple]:
        return []

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        yield from self.frame([(*key, *o) for o in self.take(key, [x for r in rows for x in self.tuples(r)])])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self.frame([(*key, *o) for o in self.fire(key, timerValues.getCurrentWatermarkInMs())])

    def frame(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, *self.out_columns])

    def close(self) -> None:
        pass


class KeyState:
    """A value, list or map state of the key at hand."""

    def __init__(self, of: "KeyStates", name: str):
        self.of, self.name = of, name

    def exists(self) -> bool:
        return bool(self.of.now.get(self.name))

    def get(self) -> Any:
        return self.of.now.get(self.name)

    def put(self, rows: list[tuple]) -> None:
        self.of.now[self.name] = list(rows)

    def appendValue(self, row: tuple) -> None:
        self.of.now.setdefault(self.name, []).append(row)

    def update(self, value: tuple) -> None:
        self.of.now[self.name] = tuple(value)

    def clear(self) -> None:
        self.of.now.pop(self.name, None)

    def containsKey(self, key: tuple) -> bool:
        return key in self.of.now.get(self.name, ())

    def getValue(self, key: tuple) -> tuple | None:
        return self.of.now.get(self.name, {}).get(key)

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.of.now.setdefault(self.name, {})[key] = value

    def removeKey(self, key: tuple) -> None:
        held = self.of.now.get(self.name, {})
        held.pop(key, None)
        if not held:
            self.clear()

    def keys(self) -> Iterator[tuple]:
        return iter(list(self.of.now.get(self.name, ())))

    def iterator(self) -> Iterator[tuple]:
        return iter(list(self.of.now.get(self.name, {}).items()))


class KeyStates:
    """What a processor of one key gets as its handle inside a group: states and timers of the key at hand."""

    def __init__(self) -> None:
        self.now: dict[str, Any] = {}
        self.timers: set[int] = set()

    def state(self, name: str, *_: Any) -> KeyState:
        return KeyState(self, name)

    getValueState = getListState = getMapState = state

    def registerTimer(self, ms: int) -> None:
        self.timers.add(ms)


class Groups(StatefulProcessor):
    """Runs a processor of one key for all keys of a group. The states and timers of its keys are one value of the group, and the group has
    one timer, the earliest of its keys."""

    def __init__(self, inner: KeyProcessor):
        self.inner = inner

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", "states binary")
        self.due = handle.getValueState("due", "ms bigint")
        self.key_states = KeyStates()
        self.inner.init(self.key_states)

    def load(self) -> dict[str, tuple[dict, set]]:
        held = self.memory.get()
        return pickle.loads(bytes(held[0])) if held is not None else {}

    def save(self, memory: dict[str, tuple[dict, set]]) -> None:
        if memory:
            self.memory.update((pickle.dumps(memory, pickle.HIGHEST_PROTOCOL),))
        else:
            self.memory.clear()

    def timer(self, ms: int | None, fired: bool = False) -> None:
        """The group's one timer; one that has fired goes by itself."""
        held = self.due.get()
        old = held[0] if held is not None else None
        if ms == old and not fired:
            return
        if old is not None and not fired:
            self.handle.deleteTimer(old)
        if ms is not None:
            self.handle.registerTimer(ms)
            self.due.update((ms,))
        elif old is not None:
            self.due.clear()

    def run(self, memory: dict[str, tuple[dict, set]], key: str, mark_ms: int | None, call: Callable[[], list[tuple]]) -> list[tuple]:
        """Call the processor with the key's states at hand; timers up to the mark are done with."""
        now, timers = memory.get(key, ({}, set()))
        states = self.key_states
        states.now, states.timers = now, timers if mark_ms is None else {t for t in timers if t > mark_ms}
        out = call()
        if states.now or states.timers:
            memory[key] = (states.now, states.timers)
        else:
            memory.pop(key, None)
        return [(key, *o) for o in out]

    def by_key(self, rows: Iterator[pd.DataFrame]) -> dict[str, list[tuple]]:
        per: dict[str, list[tuple]] = {}
        for r in rows:
            for k, row in zip(r[KEY].tolist(), self.inner.tuples(r)):
                per.setdefault(k, []).append(row)
        return per

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        memory, out = self.load(), []
        for k, mine in self.by_key(rows).items():
            out += self.run(memory, k, None, lambda: self.inner.take((k,), mine))
        self.save(memory)
        self.timer(min((t for _, timers in memory.values() for t in timers), default=None))
        yield from self.frame(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark_ms, memory, out = timerValues.getCurrentWatermarkInMs(), self.load(), []
        for k in [k for k, (_, timers) in memory.items() if timers and min(timers) <= mark_ms]:
            out += self.run(memory, k, mark_ms, lambda: self.inner.fire((k,), mark_ms))
        self.save(memory)
        self.timer(min((t for _, timers in memory.values() for t in timers), default=None), True)
        yield from self.frame(out)

    def frame(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=[KEY, *self.inner.out_columns])

    def close(self) -> None:
        pass


def with_groups(df: DataFrame, keys: Keys, processor: Groups, out: str, mode: str = "append", time: str = "None", groups: int = GROUPS) -> DataFrame:
    """Run a processor for groups of keys: ``<keys>`` and the columns ``out``. A key's group is its hash.

    ``groups`` stays what it is for the life of a checkpoint, as the number of state stores does: a task holds one group's due rows and
    states at a time, and a batch makes some calls to the state store for each group.
    """
    k = as_list(keys)
    d = df.withColumn(KEY, F.to_json(F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(k)]), KEY_JSON)).drop(*k)
    d = d.withColumn(GROUP, F.pmod(F.xxhash64(KEY), F.lit(groups)).cast("int"))
    schema = T.StructType([T.StructField(str(i), df.schema[c].dataType) for i, c in enumerate(k)])
    got = with_state(d, GROUP, processor, f"{KEY} string, {out}", mode, time)
    rest = [c for c in got.columns if c != KEY]
    got = got.withColumn(KEY, F.from_json(KEY, schema, KEY_JSON))
    return got.select(*[F.col(KEY)[str(i)].alias(c) for i, c in enumerate(k)], *rest)


# ---- counters ----------------------------------------------------------------------------------------------

class Counter(KeyProcessor):
    """Running number of rows per key; each batch emits the key's new count."""
    out_columns = ["n"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.count = handle.getValueState("count", "n bigint")

    def tuples(self, r: pd.DataFrame) -> list[tuple]:
        return [()] * len(r)

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        n = (self.count.get()[0] if self.count.exists() else 0) + len(rows)
        self.count.update((n,))
        return [(n,)]


def stream_counter(df: DataFrame, keys: Keys) -> DataFrame:
    k = as_list(keys)
    return with_groups(df.select(*k), k, Groups(Counter([KEY])), "n bigint", "update")


# ---- rows in order -----------------------------------------------------------------------------------------


ROW = "us bigint, id string, label string, v double"
PIECE = "us array<bigint>, id array<string>, label array<string>, v array<double>"
PIECES, LEAST_ROWS, MOST_ROWS = 16, 64, 4096


def in_order(row: tuple) -> tuple:
    """Time, then id (numbers by size), NULL first."""
    us, i = row[0], row[1]
    return (us, i is not None, len(i or ""), i or "")


class Waiting:
    """Rows in pieces of consecutive rows by time, in the map state ``waiting``. What a batch brings is kept as about ``PIECES`` pieces (of
    at most ``MOST_ROWS`` rows), each under its first and last time. A timer reads the pieces that the watermark has reached and lists
    the others by their times only; of a piece that the watermark cuts, the later rows are put back.
    """

    def add(self, new: list[tuple]) -> None:
        new.sort(key=in_order)
        step = min(max(-(-len(new) // PIECES), LEAST_ROWS), MOST_ROWS)
        for i in range(0, len(new), step):
            self.hold(new[i:i + step])

    def hold(self, rows: list[tuple]) -> None:
        """Keep rows that stand in order as one piece."""
        n = 0
        while self.waiting.containsKey((rows[0][0], rows[-1][0], n)):
            n += 1
        self.waiting.updateValue((rows[0][0], rows[-1][0], n), tuple(list(c) for c in zip(*rows)))

    def reached(self, mark: int) -> tuple[list[tuple], int | None]:
        """Rows up to the mark, in order, which go from the state, and the earliest time that stays."""
        ready, later = [], []
        for piece in [tuple(k) for k in self.waiting.keys()]:
            if piece[0] > mark:
                later.append(piece[0])
                continue
            rows = list(zip(*self.waiting.getValue(piece)))
            self.waiting.removeKey(piece)
            cut = len(rows) if piece[1] <= mark else bisect_right([r[0] for r in rows], mark)
            ready += rows[:cut]
            if cut < len(rows):
                self.hold(rows[cut:])
                later.append(rows[cut][0])
        return sorted(ready, key=in_order), min(later, default=None)


class OrderedRows(Waiting, KeyProcessor):
    """Base: rows are held until the watermark passes them, then handed on in order of time and id.

    ``process(key, rows, carried)`` gets (microseconds, id, label, value) tuples in order and returns output rows and what to
    carry on (tuples of the same shape). The input has the columns of ``ordered_input``. With ``keep_us`` the state of a key goes that
    long after its last carried row; ``wake`` names a time at which the key is to be looked at again even if it stays silent.
    """
    columns = ["row_us", "row_id", "row_label", "row_value"]
    keep_us: int | None = None
    mark = 0                                                 # the watermark (microseconds) while ``process`` runs

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "first bigint, last bigint, n bigint", PIECE)
        self.carry = handle.getListState("carry", ROW)

    def tuples(self, r: pd.DataFrame) -> list[tuple]:
        return [(None if us is None else int(us), *rest) for us, *rest in plain(r, self.columns)]

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        new = [r for r in rows if r[0] is not None]
        if new:
            self.add(new)
            self.handle.registerTimer(new[0][0] // 1000 + 1)         # the earliest one; it sets the next when it fires
        return []

    def fire(self, key: tuple, mark_ms: int) -> list[tuple]:
        ready, later = self.reached(mark_ms * 1000)
        if later is not None:
            self.handle.registerTimer(later // 1000 + 1)
        return self.advance(key, ready, mark_ms * 1000)

    def advance(self, key: tuple, ready: list[tuple], mark: int) -> list[tuple]:
        """Hand on rows that are due, with what the key carries."""
        self.mark = mark
        old = [tuple(r) for r in self.carry.get()] if self.carry.exists() else []
        out, keep = self.process(key, ready, old)
        if keep and self.keep_us is not None and keep[-1][0] + self.keep_us < mark:
            keep = []                                        # no row that can still come is near enough to meet it
        wake = self.wake(keep)
        if wake is not None:
            self.handle.registerTimer(wake // 1000 + 1)
        if keep:
            self.carry.put(keep)
        elif old:
            self.carry.clear()
        return out

    def process(self, key: tuple, rows: list[tuple], old: list[tuple]) -> tuple[list[tuple], list[tuple]]:
        raise NotImplementedError

    def wake(self, keep: list[tuple]) -> int | None:
        return keep[-1][0] + self.keep_us if keep and self.keep_us is not None else None


class OrderedGroups(Waiting, Groups):
    """``OrderedRows`` for all keys of a group: rows of all its keys wait in common pieces, which a timer reads as far as they are due."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "first bigint, last bigint, n bigint", PIECE + ", key array<string>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = [(*row, k) for r in rows for k, row in zip(r[KEY].tolist(), self.inner.tuples(r)) if row[0] is not None]
        if new:
            self.add(new)
            ms, held = new[0][0] // 1000 + 1, self.due.get()
            self.timer(ms if held is None else min(ms, held[0]))
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark_ms, memory, out, per = timerValues.getCurrentWatermarkInMs(), self.load(), [], {}
        ready, later = self.reached(mark_ms * 1000)
        for *row, k in ready:
            per.setdefault(k, []).append(tuple(row))
        for k, (_, timers) in memory.items():
            if timers and min(timers) <= mark_ms:
                per.setdefault(k, [])
        for k, mine in per.items():
            if k in memory:
                memory[k][1].clear()                         # it says anew when it wants to be looked at
            out += self.run(memory, k, mark_ms, lambda: self.inner.advance((k,), mine, mark_ms * 1000))
        if per:
            self.save(memory)
        wakes = [t for _, timers in memory.values() for t in timers]
        self.timer(min(wakes if later is None else [*wakes, later // 1000 + 1], default=None), True)
        yield from self.frame(out)


def ordered_input(df: DataFrame, keys: list[str], ts: str, row_id: Column | str, label: Column | None = None, value: Column | None = None) -> DataFrame:
    """Keys, watermarked time and the four columns ``OrderedRows`` reads."""
    i = F.col(row_id) if isinstance(row_id, str) else row_id
    return df.select(*keys, ts, F.unix_micros(ts).alias("row_us"), i.cast("string").alias("row_id"),
                     (label if label is not None else F.lit(None)).cast("string").alias("row_label"),
                     (value if value is not None else F.lit(None)).cast("double").alias("row_value"))


def run_ordered(df: DataFrame, keys: Keys, processor: OrderedRows, out: str) -> DataFrame:
    return with_groups(df, keys, OrderedGroups(processor), out, "append", "EventTime")


class SlidingSum:
    """Sum and number of the values of a queue; nothing is subtracted, so floats do not drift and NULLs do no harm."""

    def __init__(self) -> None:
        self.front: list[tuple[tuple, float, int]] = []       # oldest last, each with the sum and number from it on
        self.back: deque[tuple] = deque()
        self.total, self.values = 0.0, 0

    def push(self, row: tuple) -> None:
        self.back.append(row)
        if row[3] is not None:
            self.total, self.values = self.total + row[3], self.values + 1

    def drop_before(self, us: int) -> None:
        while len(self):
            if not self.front:
                total, n = 0.0, 0
                while self.back:
                    row = self.back.pop()
                    if row[3] is not None:
                        total, n = total + row[3], n + 1
                    self.front.append((row, total, n))
                self.total, self.values = 0.0, 0
            if self.front[-1][0][0] >= us:
                return
            self.front.pop()

    def __len__(self) -> int:
        return len(self.front) + len(self.back)

    def sum(self) -> float | None:
        if self.front:
            total, n = self.front[-1][1] + self.total, self.front[-1][2] + self.values
        else:
            total, n = self.total, self.values
        return total if n else None

    def rows(self) -> list[tuple]:
        return [r for r, _, _ in reversed(self.front)] + list(self.back)


class RangeOver(OrderedRows):
    """Count of rows and sum of values over the last ``back`` microseconds, equal times included."""
    out_columns = ["label", "us", "n", "total"]

    def __init__(self, keys: list[str], back_us: int):
        super().__init__(keys)
        self.back_us = back_us

    def process(self, key, rows, old):
        line, out, i = SlidingSum(), [], 0
        for r in old:
            line.push(r)
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j][0] == rows[i][0]:          # rows of equal time see one another
                line.push(rows[j])
                j += 1
            line.drop_before(rows[i][0] - self.back_us)
            out += [(r[1], r[0], len(line), line.sum()) for r in rows[i:j]]
            i = j
        return out, line.rows()


class Crossing(RangeOver):
    """BLOCK when the rolling total or count rises over its limit, UNBLOCK when it falls back."""
    out_columns = ["action", "us", "row_id"]

    def __init__(self, keys: list[str], back_us: int, max_total: float, max_count: int):
        super().__init__(keys, back_us)
        self.max_total, self.max_count = max_total, max_count

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "total double, n bigint")

    def process(self, key, rows, old):
        rolled, keep = super().process(key, rows, old)
        total0, n0 = self.last.get() if self.last.exists() else (None, None)
        out = []
        for i, us, n, total in rolled:
            total = None if total is None else round(total, 2)
            both = total is not None and total0 is not None
            if (both and total > self.max_total >= total0) or (n0 is not None and n > self.max_count >= n0):
                out.append(("BLOCK", us, i))
            if (both and total <= self.max_total < total0) or (n0 is not None and n <= self.max_count < n0):
                out.append(("UNBLOCK", us, i))
            total0, n0 = total, n
        if rolled:
            self.last.update((total0, n0))
        return out, keep


class OnChange(OrderedRows):
    """Rows whose label differs from the row before: the one before is NULL, or both are there and differ."""
    out_columns = ["id", "label", "us"]

    def process(self, key, rows, old):
        out, prev = [], old[-1][2] if old else None
        for us, i, label, _ in rows:
            if prev is None or (label is not None and label != prev):
                out.append((i, label, us))
            prev = label
        return out, rows[-1:] or old


class Lag(OrderedRows):
    """Each row with the value of the row before it."""
    out_columns = ["id", "us", "value", "prev_value"]

    def process(self, key, rows, old):
        out, prev = [], old[-1][3] if old else None
        for us, i, _, v in rows:
            out.append((i, us, v, prev))
            prev = v
        return out, rows[-1:] or old


class CarryForward(OrderedRows):
    """Each row with the last value that was not NULL, its own included."""
    out_columns = ["id", "us", "value"]

    def process(self, key, rows, old):
        out, last = [], old[-1] if old else None
        for r in rows:
            last = r if r[3] is not None else last
            out.append((r[1], r[0], last[3] if last else None))
        return out, [last] if last else []


class RunningTotal(OrderedRows):
    """Each row with the total of its key so far (NULL before the first value)."""
    out_columns = ["id", "us", "total"]

    def process(self, key, rows, old):
        total, out = old[-1][3] if old else None, []
        for us, i, _, v in rows:
            total = v if total is None else total + (v or 0.0)
            out.append((i, us, total))
        return out, [(rows[-1][0], None, None, total)] if rows else old


class CountWindow(OrderedRows):
    """Sum of every ``n`` consecutive rows."""
    out_columns = ["total", "last_us"]

    def __init__(self, keys: list[str], n: int):
        super().__init__(keys)
        self.n = n

    def process(self, key, rows, old):
        line = old + rows
        full = len(line) // self.n * self.n
        parts = [line[i:i + self.n] for i in range(0, full, self.n)]
        values = [[r[3] for r in p if r[3] is not None] for p in parts]
        return [(sum(v) if v else None, p[-1][0]) for p, v in zip(parts, values)], line[full:]


class Pauses(OrderedRows):
    """Flag a row that comes more than ``gap`` microseconds after the row before it (NULL for the first)."""
    out_columns = ["label", "long_pause"]

    def __init__(self, keys: list[str], gap_us: int):
        super().__init__(keys)
        self.gap_us = gap_us

    def process(self, key, rows, old):
        out, before = [], old[-1][0] if old else None
        for us, i, _, _ in rows:
            out.append((i, None if before is None else us - before > self.gap_us))
            before = us
        return out, rows[-1:] or old


class ForgetfulDedup(OrderedRows):
    """First row of a key, and again after the key was silent for longer than the TTL (each row renews it)."""
    out_columns = ["id", "us"]

    def __init__(self, keys: list[str], ttl_us: int):
        super().__init__(keys)
        self.ttl_us = self.keep_us = ttl_us

    def process(self, key, rows, old):
        out, before = [], old[-1][0] if old else None
        for us, i, _, _ in rows:
            if before is None or us - before > self.ttl_us:
                out.append((i, us))
            before = us
        return out, rows[-1:] or old


class KeepFirst(OrderedRows):
    """The first row of a key, by time and id; later ones, however late they come back, are not reported."""
    out_columns = ["id", "us"]

    def process(self, key, rows, old):
        if old or not rows:
            return [], old
        return [(rows[0][1], rows[0][0])], rows[:1]


class LastRows(OrderedRows):
    """Number of rows, least and largest value over a row and the ``n`` rows before it; NULL values count as rows only."""
    out_columns = ["id", "us", "n", "low", "top"]

    def __init__(self, keys: list[str], n: int):
        super().__init__(keys)
        self.n = n

    def process(self, key, rows, old):
        line, low, top, out = old + rows, deque(), deque(), []    # places of values that no later one beats, the best one first
        for i, (us, row_id, _, v) in enumerate(line):
            if v is not None:
                while low and line[low[-1]][3] >= v:
                    low.pop()
                while top and line[top[-1]][3] <= v:
                    top.pop()
                low.append(i)
                top.append(i)
            for places in (low, top):
                if places and places[0] < i - self.n:
                    places.popleft()
            if i >= len(old):
                out.append((row_id, us, min(i, self.n) + 1, line[low[0]][3] if low else None, line[top[0]][3] if top else None))
        return out, line[max(len(line) - self.n, 0):]


class PairOnce(OrderedRows):
    """First unmatched left row with first unmatched right row, in order of time; each row is used once.

    Labels ``l`` and ``r`` name the sides. Rows that found no partner within the TTL are forgotten.
    """
    out_columns = ["left_id", "right_id"]

    def __init__(self, keys: list[str], ttl_us: int | None):
        super().__init__(keys)
        self.ttl_us = self.keep_us = ttl_us

    def process(self, key, rows, old):
        waiting, out = deque(old), []              # one side only: the other one has met its partners
        for r in rows:
            while waiting and self.ttl_us is not None and r[0] - waiting[0][0] > self.ttl_us:
                waiting.popleft()
            if waiting and waiting[0][2] != r[2]:
                other = waiting.popleft()
                out.append((other[1], r[1]) if r[2] == "r" else (r[1], other[1]))
            else:
                waiting.append(r)
        return out, list(waiting)


class AsOf(OrderedRows):
    """Facts with the version of their key valid at their time. A version is forgotten once a newer one is behind the watermark.

    Labels: ``f`` facts (id = row id), ``v`` versions (id = payload). A version of the fact's own time counts; of versions of equal
    time the one with the largest payload does.
    """
    out_columns = ["id", "us", "version", "version_us"]

    def process(self, key, rows, old):
        out, now = [], old[-1] if old else None
        for r in sorted(rows, key=lambda r: (r[0], r[2] == "f", in_order(r) if r[2] == "f" else (r[1] or "",))):
            if r[2] == "v":
                now = r
            else:
                out.append((r[1], r[0], now[1] if now else None, now[0] if now else None))
        return out, [now] if now else []


def _time(out: DataFrame, ts: str) -> DataFrame:
    return out.withColumn(ts, F.timestamp_micros("us")).drop("us")


def _us(span: str) -> int:
    return round(seconds(span) * 1_000_000)


def stream_pauses(df: DataFrame, keys: Keys, ts: str, row_id: str, gap: str) -> DataFrame:
    k = as_list(keys)
    return run_ordered(ordered_input(df, k, ts, row_id), k, Pauses(k, _us(gap)), "label string, long_pause boolean")


def stream_over_range(df: DataFrame, keys: Keys, ts: str, back: str, label: str, value: str) -> DataFrame:
    """OVER (RANGE ``back`` PRECEDING) on a watermarked stream: each row once, when the watermark passes it."""
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, label, None, F.col(value)), k, RangeOver(k, _us(back)), "label string, us bigint, n bigint, total double"), ts)


def stream_crossing_alerts(df: DataFrame, keys: Keys, ts: str, back: str, value: str, max_total: float, max_count: int, row_id: str) -> DataFrame:
    """BLOCK / UNBLOCK alerts of a rolling total and count (see ``over.crossing_alerts``)."""
    k = as_list(keys)
    p = Crossing(k, _us(back), max_total, max_count)
    return _time(run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, p, "action string, us bigint, row_id string"), ts)


def stream_on_change(df: DataFrame, keys: Keys, ts: str, col: str, row_id: str) -> DataFrame:
    k = as_list(keys)
    out = run_ordered(ordered_input(df, k, ts, row_id, F.col(col)), k, OnChange(k), "id string, label string, us bigint")
    return _time(out.select(*k, F.col("id").alias(row_id), F.col("label").alias(col), "us"), ts)


def stream_lag(df: DataFrame, keys: Keys, ts: str, value: str, row_id: str) -> DataFrame:
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, Lag(k), "id string, us bigint, value double, prev_value double"), ts)


def stream_locf(df: DataFrame, keys: Keys, ts: str, value: Column, row_id: str) -> DataFrame:
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, row_id, None, value), k, CarryForward(k), "id string, us bigint, value double"), ts)


def stream_running_total(df: DataFrame, keys: Keys, ts: str, value: str, row_id: str) -> DataFrame:
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, RunningTotal(k), "id string, us bigint, total double"), ts)


def stream_count_window(df: DataFrame, keys: Keys, ts: str, n: int, value: str, row_id: str) -> DataFrame:
    k = as_list(keys)
    return run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, CountWindow(k, n), "total double, last_us bigint")


def stream_first_per_value(df: DataFrame, keys: Keys, ts: str, col: str, row_id: str) -> DataFrame:
    """First row of each (key, value): ``<keys>, <col>, id, <ts>``. State: one row for each pair, kept for good."""
    k = [*as_list(keys), col]
    return _time(run_ordered(ordered_input(df, k, ts, row_id), k, KeepFirst(k), "id string, us bigint"), ts)


def stream_over_rows(df: DataFrame, keys: Keys, ts: str, n: int, value: str, row_id: str) -> DataFrame:
    """Count, least and largest value over a row and the ``n`` rows before it: ``<keys>, id, <ts>, n, low, top``. State: ``n`` rows a key."""
    k = as_list(keys)
    d = ordered_input(df, k, ts, row_id, None, F.col(value))
    return _time(run_ordered(d, k, LastRows(k, n), "id string, us bigint, n bigint, low double, top double"), ts)


def stream_dedup_ttl(df: DataFrame, keys: Keys, ts: str, row_id: str, ttl: str) -> DataFrame:
    """First row per key; a key that was silent for longer than ``ttl`` counts as new."""
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, row_id), k, ForgetfulDedup(k, _us(ttl)), "id string, us bigint"), ts)


def stream_pair_once(df: DataFrame, keys: Keys, ts: str, is_left: Column, is_right: Column, row_id: str, ttl: str | None = None) -> DataFrame:
    """Pair left and right rows of a key one to one in order of event time, whatever order they arrive in. Rows without key meet nothing.

    Rows of other kinds move the watermark; leave them out before it with ``streams.pick``. ``ttl``: how long a row may wait.
    """
    k = as_list(keys)
    d = ordered_input(df, k, ts, row_id, F.when(all_of([F.col(c).isNotNull() for c in k]), F.when(is_left, "l").when(is_right, "r"))).filter("row_label is not null or row_us is null")
    return run_ordered(d, k, PairOnce(k, _us(ttl) if ttl else None), "left_id string, right_id string")


def stream_join_asof(df: DataFrame, keys: Keys, ts: str, is_fact: Column, is_version: Column, row_id: str, payload: Column) -> DataFrame:
    """As-of join of facts and versions that arrive in one stream: ``<keys>, id, version, <ts>, version_us`` of every fact.

    ``payload`` is what a version brings (text); unmatched facts and facts without key have NULL. Each fact comes out once the watermark has passed it.
    """
    k = as_list(keys)
    kind = F.when(is_fact, "f").when(is_version & all_of([F.col(c).isNotNull() for c in k]), "v")
    d = ordered_input(df.withColumn("__kind", kind), k, ts, F.when(F.col("__kind") == "v", payload.cast("string")).otherwise(F.col(row_id).cast("string")), F.col("__kind"))
    d = d.filter("row_label is not null or row_us is null")
    return _time(run_ordered(d, k, AsOf(k), "id string, us bigint, version string, version_us bigint"), ts)


class FollowUp(KeyProcessor):
    """Report an opening row when no closing row of its key comes within the timeout."""
    out_columns = ["id", "us"]

    def __init__(self, keys: list[str], ts: str, timeout_us: int):
        super().__init__(keys)
        self.ts, self.timeout_us = ts, timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.opened = handle.getListState("opened", "us bigint, id string")
        self.closed = handle.getListState("closed", "us bigint")

    def tuples(self, r: pd.DataFrame) -> list[tuple]:
        us = r[self.ts].astype("datetime64[us]").astype("int64").tolist()
        return list(zip(us, r["row_id_"].tolist(), r["row_open"].tolist(), r["row_close"].tolist()))

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        for t, i, o, c in rows:
            if o:
                self.opened.appendValue((t, i))
                self.handle.registerTimer((t + self.timeout_us) // 1000 + 1)
            if c:                                            # an own timer, so that it goes even if nothing was opened
                self.closed.appendValue((t,))
                self.handle.registerTimer(t // 1000 + 1)
        return []

    def fire(self, key: tuple, mark_ms: int) -> list[tuple]:
        mark = mark_ms * 1000
        opened = sorted(tuple(o) for o in self.opened.get()) if self.opened.exists() else []
        closed = sorted(c[0] for c in self.closed.get()) if self.closed.exists() else []
        due = [o for o in opened if o[0] + self.timeout_us <= mark]
        left = [o for o in opened if o[0] + self.timeout_us > mark]
        nearest = [bisect_left(closed, t) for t, _ in due]
        out = [(i, t) for (t, i), at in zip(due, nearest) if at == len(closed) or closed[at] > t + self.timeout_us]
        if due:
            self.opened.put(left) if left else self.opened.clear()
        # no opening row at or before the watermark can still come: closings before it serve only those that wait
        floor = min(left[0][0], mark) if left else mark
        still = [(c,) for c in closed if c >= floor]
        if len(still) < len(closed):
            self.closed.put(still) if still else self.closed.clear()
        return out


def stream_missing_followup(df: DataFrame, keys: Keys, ts: str, is_open: Column, is_close: Column, timeout: str, row_id: str) -> DataFrame:
    """Opening rows without a closing row of their key within ``timeout``, reported when that time has passed; those without key always are.

    Rows of other kinds move the watermark; leave them out before it with ``streams.pick``.
    """
    k = as_list(keys)
    d = df.select(*k, ts, F.col(row_id).cast("string").alias("row_id_"), F.coalesce(is_open, F.lit(False)).alias("row_open"),
                  F.coalesce(is_close & all_of([F.col(c).isNotNull() for c in k]), F.lit(False)).alias("row_close"))
    out = with_groups(d, k, Groups(FollowUp(k, ts, round(seconds(timeout) * 1_000_000))), "id string, us bigint", "append", "EventTime")
    return _time(out, ts)
