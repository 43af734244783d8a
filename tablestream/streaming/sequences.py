"""Streams of row patterns, joins with a memory of their own, and changelogs: keyed state beyond one row.

All of them hold rows until the watermark passes them and go on in order of event time (``stateful.OrderedRows``), unless they say that
they answer at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.core import Keys, as_list, seconds
from ..operators.features import Z_OF_CONFIDENCE
from ..operators.patterns import Stage, holds, relations
from .stateful import Groups, KeyProcessor, OrderedRows, _ddl, _time, _us, ordered_input, run_ordered, with_groups, with_state


# ---- sequence patterns ------------------------------------------------------------------------------------

class OpenMatches:
    """Partial matches of one key over a shared buffer: a matched row is one node that points to the row matched before it, and all
    partial matches that took it share it. A run is (stage, times, node, start, again, enter, held, fresh): the stage it is in and how
    often, its newest node, the time of its first row, whether its loop may go on, the stages that may come next, whether it is whole
    but for a greedy loop that may still go on, and whether no row came since its newest.
    """

    def __init__(self, plan: Sequence[tuple], relative: Sequence[tuple | None], within_us: int):
        self.plan, self.relative, self.within_us = plan, relative, within_us
        self.nodes: dict[int, tuple] = {}
        self.runs: list[tuple] = []
        self.next_node = 0
        self.out: list[list[tuple]] = []

    def chain(self, node: int | None) -> Iterator[tuple]:
        """Matched rows, newest first: (parent, stage, us, id, value)."""
        while node is not None and node >= 0:
            row = self.nodes[node]
            yield row
            node = row[0]

    def fits(self, stage: int, node: int | None, flags: str, value: float | None) -> bool:
        return flags[stage] == "1" and holds(self.relative[stage], value, ((r[1], r[4]) for r in self.chain(node)))

    def take(self, stage: int, times: int, parent: int, start: int, row: tuple) -> tuple:
        """The run that takes a row; a whole match is reported."""
        node, self.next_node = self.next_node, self.next_node + 1
        self.nodes[node] = (parent, stage, *row)
        _, lo, hi, _, greedy = self.plan[stage]
        again, enter, whole = hi is None or times < hi, [], False
        at = stage + 1
        while times >= lo:
            if at == len(self.plan):
                whole = True
                break
            enter.append(at)
            if not self.plan[at][3]:
                break
            at += 1
        held = whole and greedy and again
        if whole and not held:
            self.out.append(list(self.chain(node)))
        return stage, times, node, start, again, enter, held, True

    def feed(self, us: int, row_id: str | None, value: float | None, flags: str, stops: str) -> None:
        row, runs, born = (us, row_id, value), [], []
        for stage, times, node, start, again, enter, held, fresh in self.runs:
            if us - start > self.within_us:
                if held:
                    self.out.append(list(self.chain(node)))
                continue
            if again and stops[stage] == "1":
                again = False
                if held:
                    self.out.append(list(self.chain(node)))
                    held = False
            if again and self.fits(stage, node, flags, value):
                born.append(self.take(stage, times + 1, node, start, row))
                again = False
                if self.plan[stage][4]:                      # a greedy loop takes the row itself
                    enter, held = [], False
            stay = []
            for at in enter:
                how = self.plan[at][0]
                if how == "next" and not fresh:
                    continue
                if self.fits(at, node, flags, value):
                    born.append(self.take(at, 1, node, start, row))
                    if how == "followed_by_any":
                        stay.append(at)
                elif how != "next":
                    stay.append(at)
            if again or stay or held:
                runs.append((stage, times, node, start, again, stay, held, False))
        for at, (_, _, _, optional, _) in enumerate(self.plan):
            if self.fits(at, None, flags, value):
                born.append(self.take(at, 1, -1, us, row))
            if not optional:
                break
        self.runs = runs + [r for r in born if r[4] or r[5] or r[6]]

    def expire(self, mark: int) -> None:
        """Let go of the runs no row after ``mark`` can join, and of nodes no run holds."""
        stay = []
        for run in self.runs:
            if run[3] + self.within_us < mark:
                if run[6]:
                    self.out.append(list(self.chain(run[2])))
            else:
                stay.append(run)
        self.runs, used = stay, set()
        for run in stay:
            node = run[2]
            while node >= 0 and node not in used:
                used.add(node)
                node = self.nodes[node][0]
        self.nodes = {n: self.nodes[n] for n in used}


class SequenceMatch(OrderedRows):
    """Sequence pattern (see ``patterns.match_sequence``) on a stream. Labels hold a flag for each stage, then one for each ``until``."""
    out_columns = ["start_us", "end_us", "matched"]

    def __init__(self, keys: list[str], stages: Sequence[Stage], within_us: int):
        super().__init__(keys)
        self.plan = [(s.contiguity, s.at_least, s.at_most, s.optional, s.greedy) for s in stages]
        self.names, self.relative, self.within_us = [s.name for s in stages], relations(stages), within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.node_state = handle.getListState("nodes", "node bigint, parent bigint, stage int, us bigint, id string, v double")
        self.run_state = handle.getListState("runs", "stage int, times int, node bigint, start_us bigint, again boolean, enter string, held boolean, fresh boolean")

    def process(self, key, rows, old):
        open_, n = OpenMatches(self.plan, self.relative, self.within_us), len(self.plan)
        if self.run_state.exists():
            open_.nodes = {r[0]: tuple(r[1:]) for r in self.node_state.get()}
            open_.runs = [(*r[:5], [int(x) for x in r[5].split(",") if x], *r[6:]) for r in map(tuple, self.run_state.get())]
            open_.next_node = max(open_.nodes, default=-1) + 1
        had = bool(open_.runs)
        for us, i, label, v in rows:
            open_.feed(us, i, v, label[:n], label[n:])
        open_.expire(self.mark)
        if open_.runs:
            self.node_state.put([(k, *v) for k, v in open_.nodes.items()])
            self.run_state.put([(*r[:5], ",".join(map(str, r[5])), *r[6:]) for r in open_.runs])
        elif had:
            self.node_state.clear()
            self.run_state.clear()
        self.wake_us = min((r[3] for r in open_.runs), default=None)
        return [(m[-1][2], m[0][2], ">".join(f"{self.names[r[1]]}:{r[3]}" for r in reversed(m))) for m in open_.out], []

    def wake(self, keep):
        return None if self.wake_us is None else self.wake_us + self.within_us


def stream_match_sequence(df: DataFrame, keys: Keys, ts: str, stages: Sequence[Stage], within: str, row_id: str, value: str | None = None) -> DataFrame:
    """``patterns.match_sequence`` on a watermarked stream: ``<keys>, start_us, end_us, matched`` (``stage:id`` joined by ``>``).

    A match comes out once the watermark has passed its last row (a greedy loop at the end: once it cannot go on). Rows without time match
    nothing. State is what open partial matches hold, each matched row once, and goes ``within`` after their first row.
    """
    k, yes = as_list(keys), lambda c: F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0")
    flags = F.concat(*[yes(s.where) for s in stages], *[yes(s.until if s.until is not None else F.lit(False)) for s in stages])
    plain = [Stage(s.name, None, s.contiguity, s.at_least, s.at_most, s.optional, s.greedy, None, s.relative) for s in stages]
    d = ordered_input(df, k, ts, row_id, flags, F.col(value) if value else None)
    return run_ordered(d, k, SequenceMatch(k, plain, _us(within)), "start_us bigint, end_us bigint, matched string")


class RunMatch(OrderedRows):
    """Pattern A+ B with a bound on A's running average (see ``patterns.match_runs``); what is carried on is one open run."""
    out_columns = ["start_us", "last_us", "avg_value", "n"]

    def __init__(self, keys: list[str], bound: float):
        super().__init__(keys)
        self.bound = bound

    def process(self, key, rows, old):
        (start, _, _, s), (last, _, _, n) = old if old else ((0, None, None, 0.0), (0, None, None, 0))
        out, n = [], int(n)
        for us, _, _, v in rows:
            if v is None:
                continue
            if (s + v) / (n + 1) < self.bound:
                start, last, s, n = (us if n == 0 else start), us, s + v, n + 1
            elif n:
                out.append((start, last, s / n, n))
                s, n = 0.0, 0
        return out, [(start, None, None, s), (last, None, None, float(n))] if n else []


def stream_match_runs(df: DataFrame, keys: Keys, ts: str, value: str, bound: float, row_id: str) -> DataFrame:
    """``<keys>, start_us, last_us, avg_value, n`` of each run, when the row that breaks it is behind the watermark."""
    k = as_list(keys)
    return run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, RunMatch(k, bound), "start_us bigint, last_us bigint, avg_value double, n bigint")


# ---- online anomalies -----------------------------------------------------------------------------------

class Bands(OrderedRows):
    """Each row with the band of its key's earlier values; the state is their count, mean and sum of squared distances."""
    out_columns = ["id", "us", "value", "forecast_value", "lower_bound", "upper_bound", "is_anomaly"]

    def __init__(self, keys: list[str], z: float, min_train: int):
        super().__init__(keys)
        self.z, self.min_train = z, min_train

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.moments = handle.getValueState("moments", "n bigint, mean double, m2 double")

    def process(self, key, rows, old):
        n, mean, m2 = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0)
        out = []
        for us, i, _, v in rows:
            if n >= self.min_train:
                half = self.z * math.sqrt(m2 / (n - 1)) if n > 1 else None
                low, high = (mean - half, mean + half) if half is not None else (None, None)
                out.append((i, us, v, mean if n else None, low, high, half is not None and v is not None and (v < low or v > high)))
            else:
                out.append((i, us, v, None, None, None, False))
            if v is not None:
                n, apart = n + 1, v - mean
                mean += apart / n
                m2 += apart * (v - mean)
        if rows:
            self.moments.update((n, mean, m2))
        return out, []


def stream_anomalies(df: DataFrame, keys: Keys, ts: str, value: str, row_id: str, confidence: float = 95.0, min_train: int = 50) -> DataFrame:
    """``features.detect_anomalies`` online: ``<keys>, id, <ts>, value, forecast_value, lower_bound, upper_bound, is_anomaly``."""
    k = as_list(keys)
    out = run_ordered(ordered_input(df, k, ts, row_id, None, F.col(value)), k, Bands(k, Z_OF_CONFIDENCE[float(confidence)], min_train),
                      "id string, us bigint, value double, forecast_value double, lower_bound double, upper_bound double, is_anomaly boolean")
    return _time(out, ts)


# ---- joins with a memory ------------------------------------------------------------------------------

class JoinTtl(OrderedRows):
    """Left rows (label l; L once matched) wait ``left_us`` for right rows, right rows (r) ``right_us`` for left ones."""
    out_columns = ["row_kind", "left_id", "right_id", "us"]

    def __init__(self, keys: list[str], left_us: int, right_us: int, outer: bool):
        super().__init__(keys)
        self.left_us, self.right_us, self.outer = left_us, right_us, outer
        self.keep_us = max(left_us, right_us)

    def process(self, key, rows, old):
        left, right, out = [r for r in old if r[2] != "r"], [r for r in old if r[2] == "r"], []
        for row in rows:
            us, i, label, _ = row
            left = [r for r in left if us - r[0] <= self.left_us]
            right = [r for r in right if us - r[0] <= self.right_us]
            if label == "r":
                for at, other in enumerate(left):
                    if other[2] == "l":                      # its NULL row goes when the first match comes
                        if self.outer:
                            out.append(("-D", other[1], None, us))
                        left[at] = (*other[:2], "L", None)
                    out.append(("+I", other[1], i, us))
                right.append(row)
            else:
                out += [("+I", i, other[1], us) for other in right] or ([("+I", i, None, us)] if self.outer else [])
                left.append((us, i, "L" if right else "l", None))
        left = [r for r in left if self.mark - r[0] <= self.left_us]
        right = [r for r in right if self.mark - r[0] <= self.right_us]
        return out, sorted(left + right, key=lambda r: r[0])


def stream_join_ttl(df: DataFrame, keys: Keys, ts: str, is_left: Column, is_right: Column, row_id: str, left_ttl: str, right_ttl: str,
                    how: str = "inner") -> DataFrame:
    """Join of two kinds of rows of one stream, each kind remembered for a time of its own: ``<keys>, row_kind, left_id, right_id, <ts>``.

    A left row meets right rows up to ``left_ttl`` later and ``right_ttl`` earlier. With ``how="left"`` a left row that finds nothing comes
    out with NULL (+I), and that row is taken back (-D) when a match comes. Rows without key meet nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    k = as_list(keys)
    d = ordered_input(df, k, ts, row_id, F.when(is_left, "l").when(is_right, "r")).filter("row_label is not null or row_us is null")
    return _time(run_ordered(d, k, JoinTtl(k, _us(left_ttl), _us(right_ttl), how == "left"), "row_kind string, left_id string, right_id string, us bigint"), ts)


class UpsertJoin(OrderedRows):
    """Current facts of a dimension key (the reverse index) and its current dimension row. Labels: d, or f / x and the fact's own key."""
    out_columns = ["row_kind", "fact_key", "fact", "dim", "us", "seq"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.facts = handle.getMapState("facts", "k string", "fact string")
        self.now = handle.getValueState("now", "dim string, seq bigint")

    def process(self, key, rows, old):
        dim, seq = self.now.get() if self.now.exists() else (None, 0)
        out = []
        facts = {k[0]: v[0] for k, v in self.facts.iterator()} if rows and self.facts.exists() else {}
        for us, payload, label, _ in rows:
            kind, name = label[0], label[1:]
            changes = []
            if kind == "d":
                if payload != dim:
                    changes = [x for k, f in facts.items() for x in (("-U", k, f, dim), ("+U", k, f, payload))]
                    dim = payload
            elif kind == "x":
                if name in facts:
                    changes = [("-D", name, facts.pop(name), dim)]
                    self.facts.removeKey((name,))
            elif facts.get(name, 0) != payload:
                changes = [("-U", name, facts[name], dim), ("+U", name, payload, dim)] if name in facts else [("+I", name, payload, dim)]
                facts[name] = payload
                self.facts.updateValue((name,), (payload,))
            for c in changes:
                seq += 1
                out.append((*c, us, seq))
        if rows:
            self.now.update((dim, seq))
        return out, []


def stream_join_upsert(df: DataFrame, keys: Keys, ts: str, is_fact: Column, is_dim: Column, fact_key: Column, payload: Column,
                       is_delete: Column | None = None) -> DataFrame:
    """Upserted facts left join upserted dimension rows, as a changelog: ``<keys>, row_kind, fact_key, fact, dim, <ts>, seq``.

    ``keys``: the dimension key, which both kinds of rows carry (a fact that moves to another one is deleted under the old). The newest
    row of a fact key and of a dimension key by event time counts. A dimension change emits -U / +U of its own facts only; ``seq`` orders
    the changes of a dimension key, so ``apply_changelog(out, [*keys, "fact_key"], "seq")`` is the join.
    """
    k, name = as_list(keys), F.coalesce(fact_key.cast("string"), F.lit(""))
    gone = F.coalesce(is_delete, F.lit(False)) if is_delete is not None else F.lit(False)
    label = F.when(is_dim, "d").when(is_fact & gone, F.concat(F.lit("x"), name)).when(is_fact, F.concat(F.lit("f"), name))
    d = ordered_input(df, k, ts, payload, label).filter("row_label is not null or row_us is null")
    out = run_ordered(d, k, UpsertJoin(k), "row_kind string, fact_key string, fact string, dim string, us bigint, seq bigint")
    return _time(out, ts)


# ---- growing windows -------------------------------------------------------------------------------------

class Growing(StatefulProcessor):
    """Count and sum of windows that grow step by step: rows go into panes of one step, a timer at each step's end adds the pane."""

    def __init__(self, keys: list[str], step_us: int, size_us: int):
        self.keys, self.step_us, self.size_us = keys, step_us, size_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "step_end bigint", "n bigint, total double")
        self.grown = handle.getValueState("grown", "step_end bigint, n bigint, total double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new: dict[int, tuple] = {}
        for r in rows:
            for us, v in zip(r["row_us"].tolist(), r["row_value"].astype(object).where(r["row_value"].notna(), None).tolist()):
                if us is None or us != us:
                    continue
                end = (int(us) // self.step_us + 1) * self.step_us
                n, total = new.get(end, (0, None))
                new[end] = (n + 1, total if v is None else v + (total or 0.0))
        for end, (n, total) in new.items():
            if self.panes.containsKey((end,)):
                n0, total0 = self.panes.getValue((end,))
                n, total = n + n0, total0 if total is None else total + (total0 or 0.0)
            self.panes.updateValue((end,), (n, total))
            self.handle.registerTimer(end // 1000)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        end, n, total = self.grown.get() if self.grown.exists() else (None, 0, None)
        due = sorted(k[0] for k in self.panes.keys() if k[0] <= mark) if self.panes.exists() else []
        out, had = [], end is not None
        close = lambda e: -(-e // self.size_us) * self.size_us
        while True:
            after = end + self.step_us if end is not None and end < close(end) else None
            if after is not None and after <= mark and (not due or after <= due[0]):
                end = after
            elif due and (after is None or due[0] < after or after > mark):
                end, n, total = due[0], 0, None              # a new window begins
            else:
                break
            if due and due[0] == end:
                more, sum_ = self.panes.getValue((end,))
                self.panes.removeKey((end,))
                due.pop(0)
                n, total = n + more, total if sum_ is None else sum_ + (total or 0.0)
            out.append([*key, close(end) - self.size_us, end, n, total])
        if end is not None and end < close(end):
            self.grown.update((end, n, total))
            self.handle.registerTimer((end + self.step_us) // 1000)
        elif had:
            self.grown.clear()
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, "start_us", "end_us", "n", "total"])

    def close(self) -> None:
        pass


def stream_cumulate(df: DataFrame, keys: Keys, ts: str, step: str, size: str, value: Column | None = None) -> DataFrame:
    """Windows that grow by ``step`` up to ``size`` (see ``windows.cumulate``): ``window_start, window_end, <keys>, n, total``.

    Every step from a window's first row to its end comes out when the watermark passes the step. Steps are whole milliseconds.
    """
    k = as_list(keys)
    if seconds(size) % seconds(step):
        raise ValueError("size must be a multiple of step")
    d = ordered_input(df, k, ts, F.lit(None), None, value)
    out = with_state(d, k, Growing(k, _us(step), _us(size)), _ddl(df, k) + ", start_us bigint, end_us bigint, n bigint, total double", "append", "EventTime")
    return out.select(F.timestamp_micros("start_us").alias("window_start"), F.timestamp_micros("end_us").alias("window_end"), *k, "n", "total")


def stream_tumble_distinct(df: DataFrame, ts: str, size: str, keys: Keys, col: str, name: str = "n") -> DataFrame:
    """COUNT DISTINCT per window, whole in the stream: two chained states, the distinct (window, key, id) and their count; both go when
    the watermark closes the window. NULL ids do not count."""
    k = as_list(keys)
    first = df.select(F.window(ts, size).alias("w"), *k, *([col] if col not in k else [])).dropDuplicates(["w", *k, *([col] if col not in k else [])])
    return first.groupBy("w", *k).agg(F.count(col).alias(name)).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *k, name)


# ---- changelogs ----------------------------------------------------------------------------------------

class RunningTop(KeyProcessor):
    """The ``n`` best rows of a key so far; a row that enters comes out at once, one that is displaced is taken back."""
    columns, out_columns = ["row_value", "row_id"], ["row_kind", "id", "value", "seq"]

    def __init__(self, keys: list[str], n: int):
        super().__init__(keys)
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.best = handle.getListState("best", "v double, id string")
        self.seq = handle.getValueState("seq", "seq bigint")

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        rank = lambda r: (r[0], r[1] is not None, len(r[1] or ""), r[1] or "")
        best = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        seq = self.seq.get()[0] if self.seq.exists() else 0
        out = []
        for v, i in sorted(((v, i) for v, i in rows if v is not None and v == v), key=rank):
            if len(best) == self.n and rank((v, i)) <= rank(best[-1]):
                continue
            if len(best) == self.n:
                gone = best.pop()
                seq += 1
                out.append(("-D", gone[1], gone[0], seq))
            best = sorted([*best, (v, i)], key=rank, reverse=True)
            seq += 1
            out.append(("+I", i, v, seq))
        if out:
            self.best.put(best)
            self.seq.update((seq,))
        return out


def stream_top_n(df: DataFrame, keys: Keys, ts: str, value: str, row_id: str, n: int) -> DataFrame:
    """Running top ``n`` by value (ties: the larger id) as a changelog: ``<keys>, row_kind, id, value, seq``. It answers at once; rows with
    a NULL value are in no top. State: ``n`` rows a key."""
    k = as_list(keys)
    d = ordered_input(df, k, ts, row_id, None, F.col(value))
    return with_groups(d, k, Groups(RunningTop(k, n)), "row_kind string, id string, value double, seq bigint", "append")


class UpsertLog(KeyProcessor):
    """Current row of a key by sequence number; a deleted key stays as a tombstone until no older row can come."""
    columns, out_columns = ["seq", "row_id", "row_label", "row_us"], ["row_kind", "payload", "seq"]

    def __init__(self, keys: list[str], keep_us: int):
        super().__init__(keys)
        self.keep_us = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.now = handle.getValueState("now", "seq bigint, payload string, live boolean, us bigint")

    def take(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        seq, payload, live, us = self.now.get() if self.now.exists() else (None, None, False, 0)
        out, before = [], seq
        known = [(int(s), p, kind, int(at)) for s, p, kind, at in rows if s is not None and at is not None]
        for s, p, kind, at in sorted(known, key=lambda x: x[0]):
            if kind == "-U" or (seq is not None and s <= seq):            # beaten by what is known already
                continue
            if kind == "-D":
                out += [("-D", payload, s)] if live else []
            else:
                out += [("-U", payload, s), ("+U", p, s)] if live else [("+I", p, s)]
            seq, payload, live, us = s, None if kind == "-D" else p, kind != "-D", at
        if seq != before:
            self.now.update((seq, payload, live, us))
            if not live:
                self.handle.registerTimer((us + self.keep_us) // 1000 + 1)
        return out

    def fire(self, key: tuple, mark_ms: int) -> list[tuple]:
        if self.now.exists():
            _, _, live, us = self.now.get()
            if not live and us + self.keep_us < mark_ms * 1000:
                self.now.clear()
        return []


def stream_apply_changelog(df: DataFrame, keys: Keys, ts: str, seq: Column, kind: Column, payload: Column, keep: str = "7 days") -> DataFrame:
    """Table behind a changelog that comes in any order: ``<keys>, row_kind, payload, seq`` of each change to the current row, at once.

    The row of the highest ``seq`` (a BIGINT) counts; one that comes late with a lower number changes nothing. -U rows only announce.
    Tombstones are kept until the watermark is ``keep`` past them, so deleted keys stay deleted for late rows. For a live log after
    history, let ``seq`` put live rows above all of history. ``changelog.apply_changelog(out, keys, "seq")`` is the table.
    """
    k = as_list(keys)
    d = ordered_input(df.withColumn("__seq", seq.cast("long")), [*k, "__seq"], ts, payload, kind).withColumnRenamed("__seq", "seq")
    d = d.filter("seq is not null or row_us is null")
    d = d.withColumn("seq", F.col("seq").cast("string"))               # a frame with NULLs would hold numbers as floats
    return with_groups(d, k, Groups(UpsertLog(k, _us(keep))), "row_kind string, payload string, seq bigint", "append", "EventTime")


# ---- cutoffs ---------------------------------------------------------------------------------------------

class Cutoffs(OrderedRows):
    """A row for each cutoff that finds its key heard of within ``far`` but not within ``near`` of it; a timer looks at silent keys."""
    out_columns = ["id", "us"]

    def __init__(self, keys: list[str], period_us: int, offset_us: int, near_us: int, far_us: int):
        super().__init__(keys)
        self.period_us, self.offset_us, self.near_us, self.far_us = period_us, offset_us, near_us, far_us

    def _from(self, us: int) -> int:
        """First cutoff at or after ``us``."""
        return -(-(us - self.offset_us) // self.period_us) * self.period_us + self.offset_us

    def process(self, key, rows, old):
        last, done = old if old else (None, None)
        out = []
        for row in [*rows, (self.mark + 1, None, None, None)]:
            if last is not None:                             # cutoffs before the next row of the key (or up to the watermark)
                at = self._from(max(last[0] + self.near_us, done[0] + 1))
                while at < row[0] and at <= last[0] + self.far_us:
                    out.append((last[1], at))
                    at += self.period_us
            if row[0] <= self.mark:
                last, done = row, (row[0] - 1, None, None, None)
        if last is None:
            return out, []
        self.next = self._from(max(last[0] + self.near_us, self.mark + 1))
        return out, [last, (self.mark, None, None, None)] if self.next <= last[0] + self.far_us else []

    def wake(self, keep):
        return self.next if keep else None


def stream_cutoff(df: DataFrame, keys: Keys, ts: str, row_id: str, every: str, offset: str, near: str = "2 hours", far: str = "24 hours") -> DataFrame:
    """``<keys>, id, <ts>``: for each cutoff (``offset`` past every ``every`` since 1970) and key whose last row lies between ``far`` and
    ``near`` before it, that row's id and the cutoff's time. Keys that stay silent get theirs by a timer, and their state goes after ``far``."""
    k = as_list(keys)
    return _time(run_ordered(ordered_input(df, k, ts, row_id), k, Cutoffs(k, _us(every), _us(offset), _us(near), _us(far)), "id string, us bigint"), ts)
