"""Equi, outer, multi-condition, hierarchy, lookup and salted joins.

The physical join is left to Spark: AQE measures the sides at run time, broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .core import Keys, all_of, as_list, hashable, join_null_safe
from .dedup import dedup_last


def join_inner(l: DataFrame, r: DataFrame, on: Keys) -> DataFrame:
    return l.join(r, as_list(on), "inner")


def join_left(l: DataFrame, r: DataFrame, on: Keys) -> DataFrame:
    return l.join(r, as_list(on), "left")


def join_right(l: DataFrame, r: DataFrame, on: Keys) -> DataFrame:
    return l.join(r, as_list(on), "right")


def join_full(l: DataFrame, r: DataFrame, on: Keys, fill: str | None = None) -> DataFrame:
    """Full outer join; ``fill`` replaces NULL text on the unmatched side."""
    out = l.join(r, as_list(on), "full")
    if fill is None:
        return out
    text = [c for c, t in out.dtypes if t == "string" and c not in as_list(on)]
    return out.withColumns({c: F.coalesce(c, F.lit(fill)) for c in text})


def join_anti(l: DataFrame, r: DataFrame, on: Keys) -> DataFrame:
    return l.join(r, as_list(on), "left_anti")


def join_many(frames: Sequence[tuple[DataFrame, Keys]], first: DataFrame) -> DataFrame:
    """``first`` joined to each (frame, keys) in turn."""
    return reduce(lambda acc, fk: acc.join(fk[0], as_list(fk[1]), "inner"), frames, first)


def cross_stats(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    """Global statistics next to each row, as a scalar subquery."""
    from .aggs import with_stats
    return with_stats(df, df.agg(*[c.alias(n) for n, c in aggs.items()]))


def join_any(l: DataFrame, r: DataFrame, conds: Sequence[Column], how: str = "inner") -> DataFrame:
    """Join on c1 OR c2 OR ..: one equi join per condition, each leaving out pairs an earlier one made.

    An OR condition alone has no hash key and would compare every pair; here every branch has one, and
    no final DISTINCT is needed, so duplicates in the input keep their multiplicity.
    Column references must be qualified (``F.col("l.x") == F.col("r.y")`` on aliased frames).
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    parts = []
    for i, c in enumerate(conds):
        unseen = [~F.coalesce(p, F.lit(False)) for p in conds[:i]]
        parts.append(l.join(r, all_of([c, *unseen]), "inner"))
    if how == "left":
        rest = reduce(lambda acc, c: acc.join(r, c, "left_anti"), conds, l)
        parts.append(rest.join(r.limit(0), F.lit(False), "left"))
    return reduce(DataFrame.unionAll, parts)


def expand_hierarchy(edges: DataFrame, parent: str, child: str, kind: str, group_value: str = "GROUP", depth: int | None = 2) -> DataFrame:
    """(root, member) pairs reached from each parent in ``depth`` levels, or in all levels (None).

    A fixed depth goes level by level. All levels are found by doubling: the pairs known so far are joined with themselves, so each
    round reaches twice as far and a chain of any length ends after the logarithm of its length. Pairs are distinct, so a
    cycle ends too; every round starts from a checkpoint.
    """
    e = edges.select(F.col(parent).alias("root"), F.col(child).alias("member"), (F.col(kind) == group_value).alias("is_group")).distinct()
    if depth is None:
        return every_level(e).select(F.col("root").alias(parent), F.col("member").alias(child))
    step = lambda a, b: (a.filter("is_group").select("root", F.col("member").alias("via"))
                         .join(b.select(F.col("root").alias("via"), "member", "is_group"), "via").select("root", "member", "is_group"))
    levels = [e]
    for _ in range(depth - 1):
        found = step(levels[-1], e).distinct().join(reduce(DataFrame.unionAll, levels), ["root", "member", "is_group"], "left_anti")
        levels.append(cut_lineage(found) if depth > 2 else found)
    out = reduce(DataFrame.unionAll, levels).filter(~F.col("is_group"))
    return out.select(F.col("root").alias(parent), F.col("member").alias(child))


def every_level(e: DataFrame) -> DataFrame:
    """Distinct (root, leaf) pairs of distinct edges ``root, member, is_group``: doubling finds the pairs of groups, leaves come in at the end.

    A leaf with one parent is met by each root of that parent once, so its pairs are neither written nor shuffled to be made distinct; only
    those of leaves with several parents are.
    """
    step = lambda a, b: a.select("root", F.col("member").alias("via")).join(b.select(F.col("root").alias("via"), "member"), "via").select("root", "member")
    new = cut_lineage(e.filter("is_group").select("root", "member"))
    parts = [new]
    while not new.isEmpty():                                 # a new pair is joined with all, old pairs have met already
        reached = reduce(DataFrame.unionAll, parts)
        met = step(new, reached).unionByName(step(reached, new)).distinct()
        new = cut_lineage(join_null_safe(met, reached, ["root", "member"], "left_anti"))
        parts.append(new)
    groups = reduce(DataFrame.unionAll, parts).filter(~F.col("root").eqNullSafe(F.col("member")))       # the edge itself gives a leaf's own parent
    leaves = e.filter(~F.col("is_group")).select("root", "member")
    parents = leaves.groupBy("member").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("__n"))
    one = parents.filter("__n = 1").select("root", "member")
    more = join_null_safe(leaves, parents.filter("__n > 1").select("member"), ["member"], "left_semi")
    return one.unionByName(step(groups, one)).unionByName(more.unionByName(step(groups, more)).distinct())


def join_lookup(l: DataFrame, dim: DataFrame, on: Keys, status: str = "lookup_status") -> tuple[DataFrame, DataFrame]:
    """Left join to a reference table, split into (found, not found)."""
    k = as_list(on)
    hit = l.join(dim.withColumn("__hit", F.lit(True)), k, "left")
    ok = F.col("__hit").isNotNull()
    marked = hit.withColumn(status, F.when(ok, "SUCCESS").otherwise("FAILED"))
    return marked.filter(ok).drop("__hit"), marked.filter(~ok).drop("__hit")


def key_search(l: DataFrame, dim: DataFrame, on: Keys, fields: Keys, name: str = "matches") -> DataFrame:
    """Each left row with the array of its matches (empty array when there is none)."""
    k = as_list(on)
    from .aggs import collect_rows
    arr = collect_rows(dim, k, fields, name)
    out = l.join(arr, k, "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(arr.schema[name].dataType)))


def join_lateral(df: DataFrame, rows: Column, names: Keys, how: str = "inner") -> DataFrame:
    """Lateral join on a row-producing expression: an array of structs or values built from the row."""
    n = as_list(names)
    d = df.select("*", (F.explode if how == "inner" else F.explode_outer)(rows).alias("__x"))
    if len(n) == 1:
        return d.withColumnRenamed("__x", n[0])
    fields = d.schema["__x"].dataType.names
    return d.select(*df.columns, *[F.col(f"__x.{f}").alias(a) for f, a in zip(fields, n)])


def join_latest(l: DataFrame, lk: Keys, l_order, r: DataFrame, rk: Keys, r_order, on: Keys, how: str = "inner") -> DataFrame:
    """Join of the latest version of each side."""
    return dedup_last(l, lk, l_order).join(dedup_last(r, rk, r_order), as_list(on), how)


def heavy_keys(df: DataFrame, on: Keys, share: int = 1000) -> DataFrame:
    """Keys that hold more than 1/``share`` of the rows: by that definition fewer than ``share`` keys."""
    k = as_list(on)
    from .aggs import with_stats
    counts = df.groupBy(*k).agg(F.count(F.lit(1)).alias("__c"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return with_stats(counts, total).filter(F.col("__c") * share > F.col("__total")).select(*k)


def join_salted(l: DataFrame, r: DataFrame, on: Keys, n: int = 16, how: str = "inner", share: int = 1000) -> DataFrame:
    """Equi join that spreads hot left keys over ``n`` salts.

    Only hot keys are salted and only their right rows are repeated ``n`` times. The hot-key list has
    fewer than ``share`` rows whatever the data, so it may be broadcast. Left rows salt by content and by the
    partition they were read in: a task that runs again gives the same salts, and equal rows are spread too.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    k = as_list(on)
    hot = F.broadcast(heavy_keys(l, k, share).withColumn("__hot", F.lit(True)))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*hashable(l), F.spark_partition_id()), F.lit(n))).otherwise(0).cast("int")
    ls = l.join(hot, k, "left").withColumn("__salt", salt).drop("__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    rs = r.join(hot, k, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    return ls.join(rs, [*k, "__salt"], how).drop("__salt")


def expand_party(events: DataFrame, party_info: DataFrame, expand_type: str, plan_type: str,
                 keep: Keys = ("addr_street", "addr_city", "addr_state", "addr_zip")) -> DataFrame:
    """Events of ``expand_type`` spread to all accounts of the party they concern, with each account's plan.

    ``events``: event_id, event_time, context_data (JSON with eventType), event_details (array of JSON with
    account_number). The plan comes from ``plan_type`` events of the related account.
    """
    named = (events.withColumn("event_type", F.get_json_object("context_data", "$.eventType"))
             .filter(F.col("event_type").isin(expand_type, plan_type))
             .select("event_id", "event_time", "event_type", F.explode("event_details").alias("d"))
             .select("event_id", "event_time", "event_type", F.get_json_object("d", "$.account_number").alias("account_number"),
                     F.get_json_object("d", "$.plan_name").alias("plan_name"))
             .filter(F.col("account_number").isNotNull()))
    es = named.filter(F.col("event_type") == expand_type).drop("plan_name")
    plans = named.filter(F.col("event_type") == plan_type).select(F.col("account_number").alias("member"), "plan_name")
    home = party_info.select("account_number", "party_id", *as_list(keep))
    members = party_info.select("party_id", F.col("account_number").alias("member"))
    out = es.join(home, "account_number", "left").join(members, "party_id", "left").join(plans, "member", "left")
    return out.select("party_id", F.coalesce("member", "account_number").alias("related_account_id"), "event_time", "event_type",
                      "account_number", "plan_name", *as_list(keep))


def apply_group_tombstone(df: DataFrame, group: str, member: str, ts: str, deleted: str) -> DataFrame:
    """A deleted group row (empty member) marks members with an *earlier* time as deleted."""
    tomb = (df.filter((F.col(member) == "") & F.col(deleted)).groupBy(group).agg(F.max(ts).alias("__tomb")))
    out = df.filter(F.col(member) != "").join(tomb, group, "left")
    gone = F.col("__tomb").isNotNull() & (F.col(ts) < F.col("__tomb"))
    return out.withColumn(deleted, F.when(gone, True).otherwise(F.col(deleted))).select(*df.columns)


def pair_once(l: DataFrame, r: DataFrame, k: Keys, order: Keys) -> DataFrame:
    """Pair the n-th left row of a key with its n-th right row: each row is used once."""
    from .sequence import position
    keys = as_list(k)
    return position(l, keys, order, "__n").join(position(r, keys, order, "__n").drop(*as_list(order)), [*keys, "__n"]).drop("__n")


def match_broadcast(df: DataFrame, rules: DataFrame, on: Column | Keys) -> DataFrame:
    """Events matched to a rule list. Whether the list is broadcast is AQE's choice, by the size it measures at run time."""
    return df.join(rules, on if isinstance(on, Column) else as_list(on), "inner")


def build_fact(fact: DataFrame, dim: DataFrame, on: Keys, fact_ts: str, dim_ts: str, name: str = "updated_at") -> DataFrame:
    """Fact left join dimension; the row is as new as the newer of its two sources."""
    out = fact.join(dim, as_list(on), "left")
    return out.withColumn(name, F.greatest(fact_ts, dim_ts))


def join_upsert(fact: DataFrame, fact_keys: Keys, fact_order, dim: DataFrame, dim_keys: Keys, dim_order, on: Keys) -> DataFrame:
    """Current facts joined to current dimension rows: a dimension update re-prices every match."""
    return join_latest(fact, fact_keys, fact_order, dim, dim_keys, dim_order, on, "left")
