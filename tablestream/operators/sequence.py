"""Ordered per-key computations that survive a hot key.

``Window.partitionBy(key)`` sends a whole key to one task, so a key that holds a third of the rows becomes
one task with a third of the rows. Here keys are counted first (key column only, combined on the map side).
Keys a task can hold are windowed the plain way. The time line of a bigger key is cut into chunks; its rows
are windowed per (key, chunk), and what a chunk needs from earlier chunks (last row, last non-null value,
total so far) comes from a table with one row per hot (key, chunk). Results are exact either way.

Chunks hold about equal numbers of rows: the cuts are quantiles of the hot key's positions, taken from a sample by
row hash (the same rows whenever it is computed) that only hot keys pay for. One early outlier or a burst therefore does not leave a whole key in one chunk; rows of
equal position stay together.

The side table has a bound that does not depend on the data: a hot key holds more than 1/``MAX_HOT_KEYS`` of the rows, so
there are fewer than that many, all hot keys together get at most ``MAX_CHUNKS`` cuts, and keys travel as two hashes
whatever their length. That is why it may be broadcast, and rows are shuffled only once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .core import Keys, as_list, epoch_us, join_null_safe

CHUNK, HOT, POS, CUTS = "__chunk", "__hot", "__pos_us", "__cuts"
MAX_HOT_KEYS, MAX_CHUNKS = 200_000, 1_000_000
MOST_CUTS, SAMPLED = 4096, 20               # chunks of one key at most; rows sampled for each
HOT_ROWS_CONF, HOT_ROWS = "spark.tablestream.hotKeyRows", 1_000_000


def position_of(df: DataFrame, order: str) -> Column:
    """BIGINT that never falls while ``order`` rises: microseconds of a time, a scaled number."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(order).cast("long")
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        scaled = F.col(order).cast("double") * 1_000_000
        return F.greatest(F.least(scaled, F.lit(9e18)), F.lit(-9e18)).cast("long")
    return epoch_us(df, order)


def key_hashes(keys: Sequence[str]) -> dict[str, Column]:
    """Two hashes that stand for a key (NULL parts included)."""
    parts = [x for k in keys for x in (F.col(k), F.col(k).isNull())]
    return {"__h1": F.xxhash64(F.lit(0), *parts), "__h2": F.xxhash64(F.lit(1), *parts)}


def grid_for(df: DataFrame, keys: Sequence[str], order: Keys, min_width: int = 1) -> DataFrame:
    """Keys too big for one task, with the positions at which their time line is cut.

    ``order``: time or number column, then tie breakers; only these and the keys are read. ``min_width`` keeps chunks at least
    that long (a look-back must not span many chunks).
    """
    order, *ties = as_list(order)
    luck = [F.col(c) for c in dict.fromkeys([*keys, order, *ties]) if c in df.columns]
    limit = int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))
    d = df.select(*keys, position_of(df, order).alias(POS), F.pmod(F.xxhash64(*luck), F.lit(1 << 30)).alias("__luck"))
    per = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    total = per.agg(F.sum("__rows")).scalar()
    hot = per.withColumn("__total", total).filter(F.col("__rows") > F.greatest(F.lit(limit).cast("double"), F.col("__total") / MAX_HOT_KEYS))
    n = F.least(F.ceil(F.col("__rows") * 10 / limit), F.ceil(F.col("__rows") / F.col("__total") * MAX_CHUNKS), F.lit(MOST_CUTS)).cast("int")
    share = F.lit(float(SAMPLED << 30)) * n / F.col("__rows")
    hot = hot.select(*keys, n.alias("__n"), share.alias("__share")).withColumns(key_hashes(keys))
    # only rows of hot keys reach the sample; without any the join is empty and nothing is read again
    sample = d.filter(F.col(POS).isNotNull()).withColumns(key_hashes(keys)).join(F.broadcast(hot.drop(*keys)), ["__h1", "__h2"]).filter("__luck < __share")
    d = sample.groupBy(*keys, "__h1", "__h2", "__n").agg(F.array_sort(F.collect_set(POS)).alias("__at"))        # at most MOST_CUTS * SAMPLED, give or take
    nth = lambda i: F.get("__at", F.floor(i * F.size("__at") / F.col("__n")).cast("int"))
    d = d.withColumn(CUTS, F.when(F.col("__n") > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("__n") - 1), nth))).otherwise(F.array().cast("array<bigint>")))
    if min_width > 1:
        far = lambda kept, c: (F.size(kept) == 0) | (c - F.coalesce(F.element_at(kept, -1), c) >= min_width)
        d = d.withColumn(CUTS, F.aggregate(CUTS, F.array().cast("array<bigint>"), lambda kept, c: F.when(far(kept, c), F.concat(kept, F.array(c))).otherwise(kept)))
    return d.select(*keys, "__h1", "__h2", CUTS, F.lit(True).alias(HOT))


def mark_hot(df: DataFrame, keys: Sequence[str], grid: DataFrame) -> DataFrame:
    """Rows with the cuts of their hot key (NULL for all other keys)."""
    g = grid.select("__h1", "__h2", CUTS, HOT)
    return df.withColumns(key_hashes(keys)).join(F.broadcast(g), ["__h1", "__h2"], "left").drop("__h1", "__h2")


def chunk_no(pos: Column) -> Column:
    """Chunk of a position: how many cuts lie at or before it (binary search); no position comes first."""
    cuts = F.col(CUTS)
    steps = F.array(*[F.lit(MOST_CUTS >> i) for i in range(MOST_CUTS.bit_length())])
    at = F.aggregate(steps, F.lit(0), lambda a, s: F.when((a + s <= F.size(cuts)) & (F.get(cuts, a + s - 1) <= pos), a + s).otherwise(a))
    return F.when(pos.isNull(), F.lit(-1)).otherwise(at).cast("long")


def on_grid(df: DataFrame, keys: Sequence[str], order: str, grid: DataFrame) -> DataFrame:
    d = mark_hot(df.withColumn(POS, position_of(df, order)), keys, grid)
    return d.withColumn(CHUNK, F.when(F.col(HOT), chunk_no(F.col(POS))).otherwise(0)).drop(CUTS, POS)


def with_chunk(df: DataFrame, keys: Sequence[str], order: Keys, base: DataFrame | None = None) -> DataFrame:
    """Add chunk number and hot flag. ``order``: time or number column the key is ordered by, then tie breakers.

    ``base``: a frame with the same keys and about the same rows per key that is cheaper to count. The grid
    only decides how the work is cut, never the result.
    """
    return on_grid(df, keys, as_list(order)[0], grid_for(base if base is not None else df, keys, order))


def chunk_window(keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def carry_over(df: DataFrame, keys: Sequence[str], per_chunk: dict[str, Column], carried: dict[str, tuple[str, str]],
               backwards: bool = False, grid: DataFrame | None = None) -> DataFrame:
    """One row per hot (key, chunk) with values taken from the key's *earlier* chunks (later ones if ``backwards``).

    ``per_chunk``: aggregates of one chunk; ``carried``: output name -> (how, per-chunk name) with how in
    ``last`` (nearest non-null), ``sum``, ``min`` and ``max`` (so far). With ``grid`` every chunk gets a row, also
    those ``df`` has no rows in.
    """
    per = df.filter(HOT).groupBy(*keys, CHUNK).agg(*[c.alias(n) for n, c in per_chunk.items()])
    if grid is not None:
        cells = grid.select(*keys, F.explode(F.sequence(F.lit(-1).cast("long"), F.size(CUTS).cast("long"))).alias(CHUNK))
        per = join_null_safe(cells, per, [*keys, CHUNK], "left")
    line = F.col(CHUNK).desc() if backwards else F.col(CHUNK).asc()
    before = Window.partitionBy(*keys).orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    how = {"last": lambda c: F.last(c, ignorenulls=True), "sum": F.sum, "max": F.max, "min": F.min}
    return per.select(*keys, CHUNK, *[how[h](src).over(before).alias(n) for n, (h, src) in carried.items()])


def fixed_width(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(fixed_width(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.VariantType))


def attach(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the carried values to the rows of hot keys; other rows get NULL.

    The row count of ``carry`` is bounded; it is broadcast when keys and values are of fixed width too, and
    otherwise left to AQE, which knows the size by then (rows are already dealt out by key and chunk).
    """
    small = all(fixed_width(f.dataType) for f in carry.schema.fields)
    return join_null_safe(df, F.broadcast(carry) if small else carry, [*keys, CHUNK], "left")


def lag_in_order(df: DataFrame, keys: Keys, order: Keys, outputs: dict[str, str], base: DataFrame | None = None) -> DataFrame:
    """Previous row's values per key. ``order``: time column first, then tie breakers; outputs: new -> source."""
    k, o = as_list(keys), as_list(order)
    d = with_chunk(df, k, o, base)
    prev = F.struct(*[F.col(src).alias(n) for n, src in outputs.items()])
    carry = carry_over(d, k, {"__last": F.max_by(prev, F.struct(*o))}, {"__prev": ("last", "__last")})
    local = d.withColumn("__lag", F.lag(prev).over(chunk_window(k, o)))
    return (attach(local, carry, k)
            .withColumn("__lag", F.coalesce("__lag", "__prev"))
            .select(*df.columns, *[F.col(f"__lag.{n}").alias(n) for n in outputs]))


def running(df: DataFrame, keys: Keys, order: Keys, sums: dict[str, Column]) -> DataFrame:
    """Running totals per key, row by row (a running count is the total of ``lit(1)``)."""
    k, o = as_list(keys), as_list(order)
    d = with_chunk(df.withColumns({f"__in_{n}": c for n, c in sums.items()}), k, o)
    carry = carry_over(d, k, {f"__c_{n}": F.sum(f"__in_{n}") for n in sums},
                       {f"__b_{n}": ("sum", f"__c_{n}") for n in sums})
    w = chunk_window(k, o).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.sum(f"__in_{n}").over(w).alias(f"__l_{n}") for n in sums])
    total = [F.coalesce(F.col(f"__l_{n}") + F.col(f"__b_{n}"), f"__l_{n}", f"__b_{n}").alias(n) for n in sums]
    return attach(local, carry, k).select(*df.columns, *total)


def merged_moments(n: Column, mean: Column, m2: Column, n2: Column, mean2: Column, m2_2: Column) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squared distances from it of two sets of values taken together (nothing is subtracted from a total)."""
    both, apart = n + n2, mean2 - mean
    return (both, F.when(n2 == 0, mean).when(n == 0, mean2).otherwise(mean + apart * n2 / both),
            F.when(n2 == 0, m2).when(n == 0, m2_2).otherwise(m2 + m2_2 + apart * apart * n * n2 / both))


def earlier_moments(df: DataFrame, keys: Keys, order: Keys, value: Column) -> DataFrame:
    """Rows with count, mean and sum of squared distances (``__n, __mean, __m2``) of their key's *earlier* values, NULLs left out.

    The frame ends one row before the row, so no later value and not the row itself can touch them. What hot keys carry from chunk to
    chunk are merged moments, one narrow row a chunk.
    """
    k, o = as_list(keys), as_list(order)
    d = with_chunk(df.withColumn("__v", value.cast("double")), k, o)
    of = lambda w=None: [(c.over(w) if w is not None else c).alias(n) for n, c in
                         {"__n": F.count("__v"), "__mean": F.avg("__v"), "__var": F.var_pop("__v")}.items()]
    per = d.filter(HOT).groupBy(*k, CHUNK).agg(*of()).select(*k, CHUNK, "__n", F.coalesce("__mean", F.lit(0.0)).alias("__mean"),
                                                             F.coalesce(F.col("__var") * F.col("__n"), F.lit(0.0)).alias("__m2"))
    before = Window.partitionBy(*k).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__bn", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    per = per.withColumn("__bmean", F.coalesce(F.sum(F.col("__n") * F.col("__mean")).over(before) / F.nullif("__bn", F.lit(0)), F.lit(0.0)))
    # what a chunk adds to the squared distances of all chunks up to it
    added = F.when(F.col("__bn") + F.col("__n") == 0, 0.0).otherwise(
        F.col("__m2") + (F.col("__mean") - F.col("__bmean")) ** 2 * F.col("__bn") * F.col("__n") / F.nullif(F.col("__bn") + F.col("__n"), F.lit(0)))
    carry = per.select(*k, CHUNK, "__bn", "__bmean", F.coalesce(F.sum(added).over(before), F.lit(0.0)).alias("__bm2"))
    local = d.select("*", *of(chunk_window(k, o).rowsBetween(Window.unboundedPreceding, -1)))
    d = attach(local, carry, k)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    moments = merged_moments(F.coalesce("__bn", F.lit(0)), zero("__bmean"), zero("__bm2"), F.col("__n"), zero("__mean"), zero(F.col("__var") * F.col("__n")))
    return d.select(*df.columns, *[c.alias(n) for n, c in zip(("__n", "__mean", "__m2"), moments)])


def last_known(df: DataFrame, keys: Keys, order: Keys, outputs: dict[str, str]) -> DataFrame:
    """Latest non-null value up to and including the row. ``outputs``: new name -> source column."""
    k, o = as_list(keys), as_list(order)
    d = with_chunk(df, k, o)
    stamp = F.struct(*o)
    per = {f"__c_{n}": F.max_by(F.col(src), F.when(F.col(src).isNotNull(), stamp)) for n, src in outputs.items()}
    carry = carry_over(d, k, per, {f"__b_{n}": ("last", f"__c_{n}") for n in outputs})
    w = chunk_window(k, o).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.last(src, ignorenulls=True).over(w).alias(f"__l_{n}") for n, src in outputs.items()])
    keep = [c for c in df.columns if c not in outputs]
    return attach(local, carry, k).select(*keep, *[F.coalesce(f"__l_{n}", f"__b_{n}").alias(n) for n in outputs])


def next_known(df: DataFrame, keys: Keys, order: Keys, src: str, name: str) -> DataFrame:
    """First non-null ``src`` at or after the row (order: position first, then tie breakers, all descending)."""
    k, o = as_list(keys), as_list(order)
    d = with_chunk(df, k, o)
    first = F.min_by(F.col(src), F.when(F.col(src).isNotNull(), F.struct(*o)))
    carry = carry_over(d, k, {"__m": first}, {"__later": ("last", "__m")}, backwards=True)
    w = Window.partitionBy(*k, CHUNK).orderBy(*[F.col(c).desc() for c in o]).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumn("__here", F.last(src, ignorenulls=True).over(w))
    return attach(local, carry, k).select(*df.columns, F.coalesce("__here", "__later").alias(name))


def position(df: DataFrame, keys: Keys, order: Keys, name: str = "pos") -> DataFrame:
    """1-based place of the row in its key's time line (ROW_NUMBER over the whole key)."""
    return running(df, keys, order, {name: F.lit(1).cast("long")})


def range_parts(aggs: dict[str, tuple[str, Column]]) -> tuple[dict[str, Column], dict[str, tuple[str, str]]]:
    """Per-chunk aggregates and what is carried of them, for ``name -> (sum, min or max; value column)``."""
    fn = {"sum": F.sum, "min": F.min, "max": F.max}
    return {f"__c_{n}": fn[op](c) for n, (op, c) in aggs.items()}, {f"__b_{n}": (op, f"__c_{n}") for n, (op, _) in aggs.items()}


def combine(op: str, a: Column, b: Column) -> Column:
    return {"sum": lambda: F.coalesce(a + b, a, b), "min": lambda: F.least(a, b), "max": lambda: F.greatest(a, b)}[op]()
