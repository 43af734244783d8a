"""OVER aggregates: time ranges, last n rows, running totals, change detection, carry-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .core import Aggs, Keys, as_list, epoch_us, finish_aggs, join_null_safe, seconds
from .sequence import CHUNK, attach, carry_over, combine, grid_for, lag_in_order, last_known, on_grid, position, range_parts, running


def _inputs(aggs: Aggs) -> dict[str, tuple[str, Column]]:
    """What each aggregate needs of a row, as (sum, min or max; value)."""
    out: dict[str, tuple[str, Column]] = {}
    for name, (fn, c) in aggs.items():
        src = F.lit(1) if c == "*" else F.expr(c)
        there = F.when(src.isNotNull(), F.lit(1)).otherwise(0).cast("long")
        if fn == "avg":
            out |= {f"{name}__s": ("sum", src.cast("double")), f"{name}__n": ("sum", there)}
        else:
            out[name] = {"count": ("sum", there), "count_if": ("sum", F.when(src, F.lit(1)).otherwise(0).cast("long"))}.get(fn, (fn, src))
    return out


def over_range(df: DataFrame, keys: Keys, ts: str, back: str, aggs: Aggs) -> DataFrame:
    """Aggregates over RANGE BETWEEN ``back`` PRECEDING AND CURRENT ROW (rows of equal time included).

    ``aggs``: name -> (count, count_if, sum, avg, min or max; column). Time is cut into panes as long as the look-back, so a
    range is the end of one pane and the start of the next: a running aggregate forwards within the row's pane, and a backwards one
    of the pane before, looked up at ``ts - back`` on the same time line. Each row is touched a fixed number of times,
    nothing is subtracted (floats do not drift), and a pane too big for one task is cut like any hot key.
    """
    k, back_us = as_list(keys), max(1, round(seconds(back) * 1_000_000))
    us, ins, g = epoch_us(df, ts), _inputs(aggs), [*k, "__pane"]
    d = df.withColumns({"__us": us, "__pane": F.floor(us / back_us).cast("long")}).withColumns({f"__v_{n}": c for n, (_, c) in ins.items()})
    grid = grid_for(d.select(*g, "__us"), g, "__us")
    values = {n: (op, F.col(f"__v_{n}")) for n, (op, _) in ins.items()}
    per, carried = range_parts(values)
    fn = {"sum": F.sum, "min": F.min, "max": F.max}

    def upto(rows: DataFrame, carry: DataFrame, order: Column, name: str) -> DataFrame:
        w = Window.partitionBy(*g, CHUNK).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        local = rows.select("*", *[fn[op](c).over(w).alias(f"__l_{n}") for n, (op, c) in values.items()])
        return attach(local, carry, g).withColumns({f"{name}{n}": combine(op, F.col(f"__l_{n}"), F.col(f"__b_{n}")) for n, (op, _) in ins.items()})

    own = on_grid(d, g, "__us", grid)
    here = upto(own, carry_over(own, g, per, carried), F.col("__us").asc(), "__p_")
    rows = d.select(*g, "__us", *[f"__v_{n}" for n in ins])
    # rows without time are each other's range and have no pane before theirs
    probes = here.select(*k, F.coalesce(F.col("__pane") - 1, F.lit(-2**62)).alias("__pane"), (F.col("__us") - back_us).alias("__us"),
                         F.struct(*df.columns, *[f"__p_{n}" for n in ins]).alias("__row"))
    line = on_grid(rows.unionByName(probes, allowMissingColumns=True), g, "__us", grid)
    before = carry_over(on_grid(rows, g, "__us", grid), g, per, carried, backwards=True, grid=grid)
    line = upto(line, before, F.col("__us").desc(), "__s_")
    out = line.filter(F.col("__row").isNotNull()).select("__row.*", *[f"__s_{n}" for n in ins])
    out = out.select(*df.columns, *[combine(op, F.col(f"__p_{n}"), F.col(f"__s_{n}")).alias(n) for n, (op, _) in ins.items()])
    return out.select(*df.columns, *finish_aggs(aggs))


def over_rows(df: DataFrame, keys: Keys, order: Keys, n: int, aggs: dict[str, Column], block: int = 1_000_000, upto: int = 0) -> DataFrame:
    """Aggregates over the current row and the ``n`` rows before it; ``upto=-1`` leaves the current row out.

    The key's rows are numbered, then cut into blocks by number; the last ``n`` rows of a block are copied
    into the next one, so no task holds more than a block plus ``n`` rows of a key.
    """
    k, o = as_list(keys), as_list(order)
    block = max(block, n)
    p = position(df, k, o, "__pos")
    own = F.floor((F.col("__pos") - 1) / block).cast("long")
    last = F.floor((F.col("__pos") - 1 + n) / block).cast("long")
    d = p.withColumn("__first", own).withColumn("__blk", F.explode(F.sequence(own, last)))
    w = Window.partitionBy(*k, "__blk").orderBy("__pos").rowsBetween(-n, upto)
    return (d.select("*", *[c.over(w).alias(a) for a, c in aggs.items()])
            .filter(F.col("__blk") == F.col("__first")).select(*df.columns, *aggs))


def over_partition(df: DataFrame, keys: Keys, aggs: dict[str, Column]) -> DataFrame:
    """Whole-partition aggregates next to each row: aggregate once, join back (AQE splits a hot key)."""
    k = as_list(keys)
    return join_null_safe(df, df.groupBy(*k).agg(*[c.alias(n) for n, c in aggs.items()]), k)


def running_total(df: DataFrame, keys: Keys, order: Keys, value: str | Column, name: str = "running_total",
                  threshold: float | None = None, flag: str = "over_threshold") -> DataFrame:
    c = F.col(value) if isinstance(value, str) else value
    out = running(df, keys, order, {name: c})
    return out if threshold is None else out.withColumn(flag, F.col(name) > threshold)


def lag(df: DataFrame, keys: Keys, order: Keys, col: str, name: str) -> DataFrame:
    return lag_in_order(df, keys, order, {name: col})


def on_change(df: DataFrame, keys: Keys, order: Keys, col: str,
              null_safe: bool = False) -> DataFrame:
    """Rows whose ``col`` differs from the key's previous row: ``prev IS NULL OR cur <> prev``.

    With ``null_safe`` a change to or from NULL counts too (and the first row always does).
    """
    k, o = as_list(keys), as_list(order)
    if null_safe:
        d = lag_in_order(df.withColumn("__one", F.lit(1)), k, o, {"__prev": col, "__seen": "__one"})
        keep = F.col("__seen").isNull() | ~F.col("__prev").eqNullSafe(F.col(col))
    else:
        d = lag_in_order(df, k, o, {"__prev": col})
        keep = F.col("__prev").isNull() | (F.col(col) != F.col("__prev"))
    return d.filter(keep).select(*df.columns)


def locf(df: DataFrame, keys: Keys, order: Keys, cols: Keys,
         suffix: str = "") -> DataFrame:
    """Last observation carried forward for each of ``cols``."""
    return last_known(df, keys, order, {f"{c}{suffix}": c for c in as_list(cols)})


def locf_max(df: DataFrame, keys: Keys, order: Keys, cols: Keys) -> DataFrame:
    """Largest carried-forward value per key. Carrying repeats values and adds none, so the plain max is it."""
    k = as_list(keys)
    return df.groupBy(*k).agg(*[F.max(c).alias(c) for c in as_list(cols)])


def row_number(df: DataFrame, keys: Keys, order: Keys, name: str = "rn") -> DataFrame:
    return position(df, keys, order, name)


def dense_rank(df: DataFrame, keys: Keys, by: str, name: str = "rank") -> DataFrame:
    """DENSE_RANK by a number or time: number the distinct values of a key, then join the number back."""
    k = as_list(keys)
    ranked = position(df.select(*k, by).distinct(), k, by, name)
    return join_null_safe(df, ranked, [*k, by])


def window_delta(agg: DataFrame, keys: Keys, start: str, value: str) -> DataFrame:
    """Change of a windowed aggregate against the key's previous window."""
    d = lag_in_order(agg, keys, [start], {"prev_value": value})
    return d.withColumn("delta", F.col(value) - F.col("prev_value"))


def crossing_alerts(df: DataFrame, keys: Keys, order: Keys, back: str, value: str, max_total: float, max_count: int) -> DataFrame:
    """BLOCK when a rolling total or count rises over its limit, UNBLOCK when it falls back."""
    k, o = as_list(keys), as_list(order)
    roll = over_range(df.select(*k, *o, value), k, o[0], back,
                      {"total": ("sum", value), "n": ("count", "*")}).withColumn("total", F.round("total", 2))
    d = lag_in_order(roll, k, o, {"total_lag": "total", "n_lag": "n"}, base=df)
    t, tl, n, nl = (F.col(c) for c in ("total", "total_lag", "n", "n_lag"))
    up = ((t > max_total) & (tl <= max_total)) | ((n > max_count) & (nl <= max_count))
    down = ((t <= max_total) & (tl > max_total)) | ((n <= max_count) & (nl > max_count))
    # one pass instead of a union of two scans: a row may raise both actions
    acts = F.filter(F.array(F.when(up, F.lit("BLOCK")), F.when(down, F.lit("UNBLOCK"))), lambda a: a.isNotNull())
    return d.select(*k, F.explode(acts).alias("action"), F.col(o[0]).alias("updated_at"), *o[1:])
