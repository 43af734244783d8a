"""Row patterns, bursts, gaps: detection over a key's time line."""

from __future__ import annotations

import json
import operator
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .batches import group_slices
from .core import Keys, any_of, as_list, epoch_us, interval, join_null_safe, seconds
from .sequence import CHUNK, CUTS, HOT, chunk_no, grid_for, lag_in_order, mark_hot, position, running, with_chunk

# Fixed value: type of the row that stands for a key silent at the cutoff.
NO_EVENT = "proactive_no_event"


def repeat_purchase(df: DataFrame, keys: Keys, order: Keys, item: str) -> DataFrame:
    """Rows whose item equals the key's previous item (nothing in between)."""
    d = lag_in_order(df, keys, order, {"prev_item": item})
    return d.filter(F.col("prev_item") == F.col(item)).drop("prev_item")


def repeat_within(df: DataFrame, keys: Keys, item: str, ts: str, within: str, tie: Keys = ()) -> DataFrame:
    """Rows whose (key, item) was seen at most ``within`` earlier; other items may lie between."""
    k = [*as_list(keys), item]
    d = lag_in_order(df, k, [ts, *as_list(tie)], {"prev_ts": ts})
    gap = epoch_us(d, ts) - epoch_us(d, "prev_ts")
    return d.filter(gap <= round(seconds(within) * 1_000_000))


def burst(df: DataFrame, keys: Keys, ts: str, n: int, size: str) -> DataFrame:
    """(window, key) with more than ``n`` rows."""
    from .windows import tumble
    return tumble(df, ts, size, keys, {"n": ("count", "*")}).filter(F.col("n") > n)


def flapping(df: DataFrame, keys: Keys, order: Keys, col: str, n: int, size: str) -> DataFrame:
    """(window, key) in which the value changes at least ``n`` times; changes are counted inside the window only."""
    k, o = as_list(keys), as_list(order)
    d = df.select("*", F.window(o[0], size).alias("w")).select(*df.columns, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    d = lag_in_order(d, [*k, "window_start", "window_end"], o, {"__prev": col})
    changed = F.when(F.col("__prev").isNotNull() & (F.col("__prev") != F.col(col)), 1).otherwise(0)
    return (d.groupBy("window_start", "window_end", *k).agg(F.sum(changed).alias("changes")).filter(F.col("changes") >= n))


def fraud_alarms(tx: DataFrame, customer: str, card: str, city: str, order: Keys, alarmed: DataFrame, lost: DataFrame,
                 n: int = 10, changes: int = 2, size: str = "10 seconds") -> DataFrame:
    """One alarm stream of four rules: alarmed customer, lost card, too many transactions, city changes."""
    from .joins import match_broadcast
    from .relational import union_all
    key = F.col(customer).cast("string")
    a = match_broadcast(tx, alarmed.select(customer).distinct(), customer).select(key.alias("subject"), F.lit("ALARMED_CUSTOMER").alias("alarm"), F.col(as_list(order)[0]).alias("at"))
    b = match_broadcast(tx, lost.select(card).distinct(), card).select(key.alias("subject"), F.lit("LOST_CARD").alias("alarm"), F.col(as_list(order)[0]).alias("at"))
    c = burst(tx, customer, as_list(order)[0], n, size).select(key.alias("subject"), F.lit("TOO_MANY_TX").alias("alarm"), F.col("window_end").alias("at"))
    d = flapping(tx, customer, order, city, changes, size).select(key.alias("subject"), F.lit("CITY_CHANGES").alias("alarm"), F.col("window_end").alias("at"))
    return union_all([a, b, c, d])


def cutoff(events: DataFrame, triggers: DataFrame, keys: Keys, ts: str, cutoff_ts: str, received: DataFrame | None = None,
           far: str = "24 hours", near: str = "2 hours", event_type: str = "event_type", tie: Keys = ()) -> DataFrame:
    """Per cutoff one proactive row for each key that was heard of within ``far`` but not within ``near`` of it.

    The row repeats the key's last event with the cutoff as its time and type ``proactive_no_event``.
    ``received`` rows are unioned below.
    """
    from .dedup import dedup_last
    from .relational import union_all
    from .temporal import join_range
    k = as_list(keys)
    seen = join_range(triggers.select(cutoff_ts), events, cutoff_ts, ts, f"-{far}", 0)
    last = dedup_last(seen, [cutoff_ts, *k], [ts, *as_list(tie)])
    silent = last.filter(F.col(ts) <= F.col(cutoff_ts) - interval(seconds(near)))
    out = silent.withColumn(ts, F.col(cutoff_ts)).withColumn(event_type, F.lit(NO_EVENT)).select(*events.columns)
    return out if received is None else union_all([received.select(*events.columns), out])


def eta_history(events: DataFrame, key: str, ts: str, fields: Keys, latest: Keys, status: str) -> DataFrame:
    """Sorted event history per key, latest values and an ETA row from them."""
    from ..functions.udfs import estimate_delivery
    g = events.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(ts, *as_list(fields)))).alias("event_history"),
        *[F.max_by(c, ts).alias(f"{c}_latest") for c in as_list(latest)],
        F.max(ts).alias("event_ts_latest"), F.max(status).alias("shipment_status"))
    g = g.withColumn("__est", estimate_delivery("event_ts_latest"))
    return g.select("*", "__est.*").withColumn("eta_day", F.to_date("eta_window_start")).drop("__est")


def completeness(transactions: DataFrame, events: DataFrame, server: str, tx: str, expected: str, created: str, as_of: str,
                 event_keys: Keys, old_after: str = "2 hours", offset: int = 0) -> DataFrame:
    """Per server the id ranges that are loadable, complete, contiguous and old enough.

    A transaction is complete while no event is missing up to it; contiguous while ids run on without a gap
    from the first new one; loadable when complete and (contiguous or old enough).
    """
    t = transactions.groupBy(server, tx).agg(F.max(expected).alias("want"), F.max(created).alias("created"))
    e = events.select(server, tx, *as_list(event_keys)).distinct().groupBy(server, tx).agg(F.count(F.lit(1)).alias("have"))
    j = t.join(e, [server, tx], "left").withColumn("have", F.coalesce("have", F.lit(0)))
    at = F.lit(as_of).cast(transactions.schema[created].dataType)
    j = j.withColumn("old_enough", F.col("created") <= at - interval(seconds(old_after)))
    j = j.withColumn("missing", F.greatest(F.col("want") - F.col("have"), F.lit(0))).withColumn("over", (F.col("want") < F.col("have")).cast("int"))
    j = running(j, server, tx, {"cumulative_missing": F.col("missing")})
    j = position(j, [server, "old_enough"], tx, "place")
    new_start = j.filter(~F.col("old_enough")).groupBy(server).agg(F.min(tx).alias("new_start"))
    j = j.join(new_start, server, "left")
    rel = F.col("place") - 1
    j = (j.withColumn("complete", F.col("cumulative_missing") == 0)
         .withColumn("contiguous", F.when(~F.col("old_enough"), F.col(tx) - rel == F.col("new_start")))
         .withColumn("old_missing", F.when(F.col("old_enough"), F.col(tx) - rel - offset))
         .withColumn("loadable", F.col("complete") & (F.coalesce("contiguous", F.lit(False)) | F.col("old_enough"))))
    rng = lambda cond, name: [F.min(F.when(cond, F.col(tx))).alias(f"{name}_begin"), F.max(F.when(cond, F.col(tx))).alias(f"{name}_end")]
    return j.groupBy(server).agg(
        *rng(F.col("loadable"), "loadable"), *rng(F.col("complete"), "complete"), *rng(~F.col("complete"), "incomplete"),
        *rng(F.col("contiguous"), "contiguous"), *rng(~F.col("contiguous"), "noncontiguous"), *rng(F.col("old_enough"), "old_enough"),
        F.coalesce(F.max("old_missing"), F.lit(0)).alias("missing_old_transactions"), F.sum("over").alias("overcomplete_transactions"))


def seq_gap_report(a: DataFrame, b: DataFrame, seq: str, keys: Keys | None = None) -> tuple[DataFrame, DataFrame]:
    """High-water marks of two sinks with their distance, and the rows of ``a`` missing in ``b``."""
    from .aggs import with_stats
    hw = with_stats(a.agg(F.max(seq).alias("high_a"), F.count(F.lit(1)).alias("rows_a")),
                    b.agg(F.max(seq).alias("high_b"), F.count(F.lit(1)).alias("rows_b")))
    k = [*as_list(keys), seq]
    return hw.withColumn("gap", F.col("high_a") - F.coalesce("high_b", F.lit(0))), a.join(b.select(*k), k, "left_anti")


def diff_alert(df: DataFrame, keys: Keys, order: Keys, col: str) -> DataFrame:
    """Versions whose value dropped against the version before."""
    d = lag_in_order(df, keys, order, {"prev_value": col})
    return d.filter(F.col(col) < F.col("prev_value")).withColumn("drop", F.col("prev_value") - F.col(col))


# ---- sequential state machines over a key ---------------------------------------------------------

def chunked_scan(df: DataFrame, keys: Keys, order: Keys, step: Callable[[dict | None, pd.DataFrame], tuple[list[dict], dict | None]],
                 out_schema: str) -> DataFrame:
    """Run a sequential ``step(state, rows) -> (outputs, state)`` over each key; the chunks of hot keys in parallel.

    Every chunk is first run from the empty state, all at once. From the first chunk of a key whose true start state (the end state
    of the chunk before it) is another, one walk goes on in order: it carries the true state, runs the chunks that start from one and
    passes by those that start from the empty state, whose first run was right. So there are two runs, whatever the machine does; one
    that resets now and then walks over few chunks. States are small dicts (JSON), empty ones None. Rows stream through ``step`` in
    batches, none are gathered.
    """
    k, o = as_list(keys), as_list(order)
    g = [*k, CHUNK]
    rows = with_chunk(df, k, o).drop(HOT)
    types = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in g) + ", in_state string, out_state string, is_end boolean, outputs array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, start, state, out = None, None, None, []

        def flush(end: bool) -> None:
            done.append([*key, start, json.dumps(state, sort_keys=True) if end and state else None, end, list(out)])
            out.clear()

        done: list[list] = []
        for key_now, part, fresh in group_slices(batches, g):
            if fresh:
                if key is not None:
                    flush(True)
                key, start = key_now, part["__in_state"].iloc[0]
                state = json.loads(start) if start else None
            got, state = step(state, part)
            out += [json.dumps(x, default=str) for x in got]
            if len(out) > 10_000:
                flush(False)
            if len(done) > 1_000:
                yield pd.DataFrame(done, columns=[*g, "in_state", "out_state", "is_end", "outputs"])
                done.clear()
        if key is not None:
            flush(True)
            yield pd.DataFrame(done, columns=[*g, "in_state", "out_state", "is_end", "outputs"])

    def scan(part: DataFrame) -> DataFrame:
        return cut_lineage(part.repartition(*g).sortWithinPartitions(*g, *o).mapInPandas(run, schema))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Chunks of a key in order, from the true state before the first of them; a chunk that starts from the empty state was right."""
        last, now, state, out, done, skip = None, None, None, [], [], False

        def flush(end: bool) -> None:
            if now is not None and not skip:
                done.append([*now, "", json.dumps(state, sort_keys=True) if end and state else None, end, list(out)])
            out.clear()

        for key_now, part, fresh in group_slices(batches, g):
            if fresh:
                flush(True)
                if key_now[:-1] != last:
                    first = part["__before"].iloc[0]
                    state, last = json.loads(first) if first else None, key_now[:-1]
                now, skip = key_now, not state
                if skip:
                    after = part["__after"].iloc[0]
                    state = json.loads(after) if after else None
            if skip:
                continue
            got, state = step(state, part)
            out += [json.dumps(x, default=str) for x in got]
            if len(out) > 10_000:
                flush(False)
            if len(done) > 1_000:
                yield pd.DataFrame(done, columns=[*g, "in_state", "out_state", "is_end", "outputs"])
                done.clear()
        flush(True)
        yield pd.DataFrame(done, columns=[*g, "in_state", "out_state", "is_end", "outputs"])

    done = scan(rows.withColumn("__in_state", F.lit(None).cast("string")))
    ends = done.filter("is_end").select(*g, F.col("out_state").alias("__after"), F.lag("out_state").over(Window.partitionBy(*k).orderBy(CHUNK)).alias("__before"))
    wrong = ends.filter("__before is not null").groupBy(*k).agg(F.min(CHUNK).alias("__from"))          # few rows: one a hot key at most
    ends = cut_lineage(join_null_safe(ends, wrong, k).filter(F.col(CHUNK) >= F.col("__from")).drop("__from"))
    if not ends.isEmpty():
        again = join_null_safe(rows, ends, g).repartition(*k).sortWithinPartitions(*g, *o)
        fixed = cut_lineage(again.mapInPandas(walk, schema))
        done = join_null_safe(done, fixed.select(*g).distinct(), g, "left_anti").unionByName(fixed)
    out = F.from_json("x", out_schema)
    return done.select(*k, F.explode("outputs").alias("x")).select(*k, out.alias("x")).select(*k, "x.*")


def match_runs(df: DataFrame, keys: Keys, ts: str, value: str, bound: float, tie: Keys = ()) -> DataFrame:
    """Pattern A+ B, A = running average of the matched values < ``bound``, B = the row that breaks it.

    One row per match, the search goes on after B. A run that never breaks gives no match.
    """
    k, o = as_list(keys), [ts, *as_list(tie)]
    d = df.select(*k, *o, F.col(value).cast("double").alias("__v"), epoch_us(df, ts).alias("__us")).filter("__v is not null")

    def step(state: dict | None, rows: pd.DataFrame):
        start, last, s, n = (state["start"], state["last"], state["s"], state["n"]) if state else (None, None, 0.0, 0)
        outs = []
        for us, v in zip(rows["__us"].tolist(), rows["__v"].tolist()):
            if (s + v) / (n + 1) < bound:
                start, last, s, n = (us if n == 0 else start), us, s + v, n + 1
            elif n:
                outs.append({"start_us": start, "last_us": last, "avg_value": s / n, "n": n})
                start, last, s, n = None, None, 0.0, 0
        return outs, ({"start": start, "last": last, "s": s, "n": n} if n else None)

    m = chunked_scan(d, k, o, step, "start_us bigint, last_us bigint, avg_value double, n bigint")
    t = df.schema[ts].dataType.simpleString()
    zero = F.lit("1970-01-01 00:00:00").cast(t)
    stamp = lambda c: (F.timestamp_micros(c) if t == "timestamp"
                       else zero + F.make_dt_interval(secs=(F.col(c).cast("decimal(26,6)") / 1_000_000).cast("decimal(18,6)")))
    return m.select(*k, stamp("start_us").alias("start_ts"), stamp("last_us").alias("last_ts"), "avg_value", "n")


@dataclass(frozen=True)
class Stage:
    """One step of a sequence pattern.

    ``contiguity`` to the stage before: next (strict), followed_by (first later match) or followed_by_any
    (every later match). ``at_least`` / ``at_most`` repeat the stage (None = no upper limit), rows between
    repeats are skipped; ``greedy`` leaves the loop only with rows the loop itself refuses; ``until`` ends it.
    ``relative`` (operator, stage, first or last) compares the row's value with that of a matched row: (">", "a", "first") takes rows
    dearer than the first row of stage a, (">", <own name>, "last") makes a loop rise from row to row.
    """
    name: str
    where: Column
    contiguity: str = "followed_by"
    at_least: int = 1
    at_most: int | None = 1
    optional: bool = False
    greedy: bool = False
    until: Column | None = None
    relative: tuple[str, str, str] | None = None


COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq, "<>": operator.ne}


def relations(stages: Sequence[Stage]) -> list[tuple[str, int, str] | None]:
    """``Stage.relative`` with the number of the named stage."""
    names = [s.name for s in stages]
    return [None if s.relative is None else (s.relative[0], names.index(s.relative[1]), s.relative[2]) for s in stages]


def holds(relation: tuple[str, int, str] | None, value: float | None, taken: Iterator[tuple[int, float | None]]) -> bool:
    """Whether a row's value stands in ``relation`` to the value of the first or last matched row of the named stage (``taken``: stage
    and value of the matched rows, newest first). NULL stands in none; a stage that was left out sets no condition."""
    if relation is None:
        return True
    op, stage, which = relation
    other, met = None, False
    for at, v in taken:
        if at == stage:
            other, met = v, True
            if which == "last":
                break
    return not met or (value is not None and other is not None and COMPARE[op](value, other))


def find_sequences(flags: list[list[bool]], stops: list[list[bool]], times: list[int], stages: Sequence[tuple], start: int,
                   within_us: int, values: list[float | None] | None = None, relative: Sequence[tuple | None] = ()) -> list[list[tuple[int, int]]]:
    """All matches that begin at row ``start``: lists of (stage, row). ``stages``: plain tuples of Stage settings."""

    def chain(picked: tuple) -> Iterator[tuple[int, float | None]]:
        while picked:
            picked, (s, r) = picked
            yield s, values[r]

    def fits(stage: int, r: int, picked: tuple) -> bool:
        return flags[stage][r] and (values is None or holds(relative[stage], values[r], chain(picked)))

    end = start
    while end < len(times) and times[end] - times[start] <= within_us:
        end += 1
    found: list[list[tuple[int, int]]] = []
    # open partial matches, newest first: (stage taken, times, last row, matched rows as a linked list); a stack instead of calls, so a
    # loop may repeat as often as it likes
    todo: list[tuple[int, int, int, tuple]] = []

    def leave(stage: int, row: int, picked: tuple, held: int | None) -> None:
        """Go on to ``stage`` after ``row``; a greedy loop before it keeps the row ``held`` and what follows."""
        while True:
            if stage == len(stages):
                if held is None:
                    match, at = [], picked
                    while at:
                        at, pair = at
                        match.append(pair)
                    found.append(match[::-1])
                return
            how, _, _, optional, _ = stages[stage]
            last = row + 2 if how == "next" else end
            for r in range(row + 1, min(last, end)):
                if held is not None and r >= held:              # a greedy loop takes this row itself
                    break
                if fits(stage, r, picked):
                    todo.append((stage, 1, r, (picked, (stage, r))))
                    if how != "followed_by_any":
                        break
            if not optional:
                return
            stage += 1

    first = 0
    while first < len(stages):
        if flags[first][start]:
            todo.append((first, 1, start, ((), (first, start))))
        if not stages[first][3]:                            # an optional head may be left out
            break
        first += 1
    while todo:
        stage, count, row, picked = todo.pop()
        _, lo, hi, _, greedy = stages[stage]
        again = None
        if hi is None or count < hi:
            for r in range(row + 1, end):
                if stops[stage][r]:
                    break
                if fits(stage, r, picked):
                    again = r
                    break                                   # inside a loop the next fitting row is taken
        if count >= lo:
            leave(stage + 1, row, picked, again if greedy else None)
        if again is not None:
            todo.append((stage, count + 1, again, (picked, (stage, again))))
    return found


def match_sequence(df: DataFrame, keys: Keys, ts: str, stages: Sequence[Stage], within: str, tie: Keys = (),
                   id_col: str | None = None, value: str | None = None) -> DataFrame:
    """Sequence pattern per key, every match reported (no skip), all rows of a match at most ``within`` apart.

    Conditions are evaluated by Spark as flag columns; a small automaton walks the flags of a key. A hot key
    is cut into chunks; each also gets the rows up to ``within`` after its end, and a match belongs to the
    chunk of its first row, so the cut changes nothing. Memory holds the rows of one ``within``. Output: start and end time (microseconds) and one
    ``stage:id`` entry per matched row.
    """
    k, o, within_us = as_list(keys), as_list(tie), round(seconds(within) * 1_000_000)
    no = F.lit(False)
    us = epoch_us(df, ts)
    ident = F.col(id_col).cast("string") if id_col else us.cast("string")
    d = df.filter(F.col(ts).isNotNull()).select(
        *k, *[F.col(c).alias(f"__tie_{c}") for c in o], us.alias("__us"), ident.alias("__id"), (F.col(value) if value else F.lit(None)).cast("double").alias("__v"),
        *[F.coalesce(s.where, no).alias(f"__c{i}") for i, s in enumerate(stages)],
        *[F.coalesce(s.until, no).alias(f"__u{i}") if s.until is not None else no.alias(f"__u{i}") for i, s in enumerate(stages)])
    if all(s.contiguity != "next" for s in stages):              # rows no stage looks at cannot matter
        d = d.filter(any_of([F.col(f"__c{i}") | F.col(f"__u{i}") for i in range(len(stages))]))
    d = mark_hot(d, k, grid_for(d, k, "__us", max(within_us, 1)))
    own, first = chunk_no(F.col("__us")), F.greatest(chunk_no(F.col("__us") - within_us), F.lit(0).cast("long"))
    spread = F.when(F.col(HOT), F.sequence(first, own)).otherwise(F.array(F.lit(0).cast("long")))
    d = (d.withColumn("__own", F.when(F.col(HOT), own).otherwise(0)).withColumn(CHUNK, F.explode(spread))
         .drop(CUTS, HOT))
    plan = [(s.contiguity, s.at_least, s.at_most, s.optional, s.greedy) for s in stages]
    names, ties, relative = [s.name for s in stages], [f"__tie_{c}" for c in o], relations(stages)
    types = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [f"__c{i}" for i in range(len(plan))] + [f"__u{i}" for i in range(len(plan))] + ["__us", "__id", "__mine"] + ["__v"] * bool(value)
        held: dict[str, list] = {c: [] for c in columns}
        key, nxt, out = None, 0, []

        def settle(until: int | None) -> None:
            """Evaluate the starts whose whole horizon has been seen, then forget the rows before them."""
            nonlocal nxt
            times = held["__us"]
            flags, stops = [held[f"__c{i}"] for i in range(len(plan))], [held[f"__u{i}"] for i in range(len(plan))]
            while nxt < len(times) and (until is None or times[nxt] + within_us < until):
                if held["__mine"][nxt]:
                    for m in find_sequences(flags, stops, times, plan, nxt, within_us, held.get("__v"), relative):
                        out.append([*key, times[m[0][1]], times[m[-1][1]], [f"{names[s]}:{held['__id'][r]}" for s, r in m]])
                nxt += 1
            if until is None or nxt > 10_000:
                for c in columns:
                    del held[c][:nxt]
                nxt = 0

        for key_now, part, fresh in group_slices(batches, [*k, CHUNK]):
            if fresh and key is not None:
                settle(None)
            key = key_now[:-1]
            part = part.assign(__mine=part["__own"] == part[CHUNK])
            for c in columns:
                held[c] += part[c].astype(object).where(part[c].notna(), None).tolist() if c == "__v" else part[c].tolist()
            settle(held["__us"][-1])
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=[*k, "start_us", "end_us", "matched"])
                out = []
        if key is not None:
            settle(None)
        yield pd.DataFrame(out, columns=[*k, "start_us", "end_us", "matched"])

    ddl = ", ".join([f"`{c}` {types[c]}" for c in k] + ["start_us bigint", "end_us bigint", "matched array<string>"])
    return d.repartition(*k, CHUNK).sortWithinPartitions(*k, CHUNK, "__us", *ties).mapInPandas(run, ddl)
