"""Balanced label propagation: documents move towards the shards of the documents they are linked with, under quotas.

Links join documents with equal texts. As all members of a group are neighbours of one another, the neighbours' labels of a document are
the label counts of its group, so one aggregation by (group, shard) replaces the edges. Groups larger than a part of a shard are few: they
choose first, from the largest on, and each takes the fewest shards that hold it. The other documents start at random in the room that is left.
Each round a group's documents ask for a shard that holds neighbours of theirs, and the flows between the shards are balanced: a full
shard admits as many as leave it, so full shards exchange documents. Rounds go on until one moves less than a stated part of the
documents with links. At the end, documents without links even out the shards to counts at most one apart; linked ones move only where
nothing else is left, groups as a whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from .shared import body, session, written

GAIN = 0.0005                 # rounds end when two of them move no more than this part of the documents with links
STRETCHES = 4096              # of a hash, for running totals
PART = 4                      # a group of more than 1/PART of a shard chooses its shards first: at most PART groups a shard
PER_BUCKET = 50_000           # documents that are numbered in one task


def _ranked(rows: DataFrame, within: list[str], order: Column, buckets: int, name: str) -> DataFrame:
    """Number rows 0, 1, 2 ... within groups by ``order`` (a hash), without bringing a group into one task."""
    rows = rows.withColumn("_bucket", F.floor((F.shiftrightunsigned(order, 1) / F.lit(float(2**63))) * buckets).cast("int"))
    sizes = rows.groupBy(*within, "_bucket").agg(F.count("*").alias("_n"))
    w = Win.partitionBy(*within).orderBy("_bucket")
    sizes = sizes.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    inner = Win.partitionBy(*within, "_bucket").orderBy(order, "doc_id", "size", "crc")
    return rows.withColumn("_at", F.row_number().over(inner)).join(sizes, [*within, "_bucket"]).withColumn(
        name, F.col("_before") + F.col("_at") - 1).drop("_bucket", "_before", "_at")


def _choose(groups: list[int], quota: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, rows) of each group: the fullest shard that has room for all of it, or else the emptiest ones and then such a shard."""
    room = list(quota)
    out: list[list[tuple[int, int]]] = [[] for _ in groups]
    for i in sorted(range(len(groups)), key=lambda i: -groups[i]):
        left = groups[i]
        while left:
            s = min(range(len(room)), key=lambda s: (room[s] < left, room[s] if room[s] >= left else -room[s], s))
            n = min(left, room[s])
            out[i].append((s, n))
            room[s] -= n
            left -= n
    return out


def _circle(way: np.ndarray) -> list[int]:
    """Shards of a circle of ways, or none."""
    live = np.ones(len(way), bool)
    while True:
        keep = live & way[:, live].any(1) & way[live].any(0)
        if (keep == live).all():
            break
        live = keep
    if not live.any():
        return []
    walk = [int(live.argmax())]
    while (to := int((way[walk[-1]] & live).argmax())) not in walk:
        walk.append(to)
    return walk[walk.index(to):]


def _flows(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Rows that may move from shard to shard, of those that ask: no shard gets more than leave it and it has room for.

    First what two shards exchange, then circles of more, then moves into free room; each gives room to those that want to its place.
    """
    flow = np.minimum(asked, asked.T)
    left, room = asked - flow, room.copy()
    while circle := _circle(left > 0):
        edges = tuple(circle), tuple(circle[1:] + circle[:1])
        n = left[edges].min()
        left[edges] -= n
        flow[edges] += n
    while (into := np.argwhere((left > 0) & (room > 0))).size:         # no circles are left: room only goes back along the ways
        s, g = into[0]
        n = min(left[s, g], room[g])
        left[s, g] -= n
        flow[s, g] += n
        room[g] -= n
        room[s] += n
    return flow


def _propagate(blocks: DataFrame, room: list[int], rounds: int | None) -> DataFrame:
    """``h, crc, size, start, shard``: where the documents of each group that started in shard ``start`` end; ``blocks`` has their number n."""
    spark, shards, group = blocks.sparkSession, len(room), ["h", "crc", "size"]
    blocks = written(blocks.withColumn("shard", F.col("start")), "blocks")
    linked = blocks.agg(F.sum("n")).first()[0] or 0
    quiet = r = 0
    while quiet < 2 and (rounds is None or r < rounds):
        here = blocks.groupBy(*group, "shard").agg(F.sum("n").alias("n"))
        # in turn the shard with most neighbours (ties by a hash), and any that has some: the first may stay full
        luck = F.xxhash64(*group, "shard", F.lit(100 + r))
        score = F.struct("n", luck) if r % 2 == 0 else F.struct(luck)
        goal = here.groupBy(*group).agg(F.max_by("shard", score).alias("goal"), F.collect_list(F.struct("shard", "n")).alias("parts")).where(F.size("parts") > 1)
        moves = written(goal.select(*group, "goal", F.inline("parts")).where("shard <> goal"), "moves")          # at most one part a shard
        asked, free = np.zeros((shards, shards), np.int64), np.array(room, np.int64)
        for s, g, n in moves.groupBy("shard", "goal").agg(F.sum("n")).collect():
            asked[s, g] = n
        if not asked.any():
            break
        for s, n in blocks.groupBy("shard").agg(F.sum("n")).collect():
            free[s] -= n
        flow = _flows(asked, free)
        table = spark.createDataFrame([(s, g, int(flow[s, g])) for s in range(shards) for g in range(shards)], "shard int, goal int, flow long")
        order = F.xxhash64(*group, F.lit(200 + r))
        moves = moves.withColumns({"order": order, "stretch": F.pmod(order, F.lit(STRETCHES))})
        sums = moves.groupBy("shard", "goal", "stretch").agg(F.sum("n").alias("t"))
        way = Win.partitionBy("shard", "goal").orderBy("stretch")                      # at most STRETCHES rows
        sums = sums.withColumn("before", F.sum("t").over(way) - F.col("t")).join(F.broadcast(table), ["shard", "goal"]).where("before < flow").drop("t")
        inner = Win.partitionBy("shard", "goal", "stretch").orderBy("order", *group).rowsBetween(Win.unboundedPreceding, 0)
        upto = F.col("before") + F.sum("n").over(inner)
        admitted = moves.join(sums, ["shard", "goal", "stretch"]).withColumn("upto", upto).where("upto <= flow")
        admitted = written(admitted.select(*group, "shard", "goal", "n"), "admitted")
        moved = admitted.agg(F.sum("n")).first()[0] or 0
        if moved:
            blocks = blocks.join(admitted.drop("n"), [*group, "shard"], "left").withColumn("shard", F.coalesce("goal", "shard")).drop("goal")
            blocks = written(blocks, "blocks")
        quiet = quiet + 1 if moved <= GAIN * linked else 0
        r += 1
    return blocks.drop("n")


def balanced_shards(docs: DataFrame, shards: int = 8, rounds: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; only ``doc_id`` and ``text`` are read.

    ``size`` is the bytes of the text (null: none) plus one; ``slot`` numbers the rows of a shard from 0. Shard counts differ by one
    at most. ``rounds`` limits the rounds (none: see ``GAIN``). Empty and null texts are equal. Rows without doc_id and rows that repeat another take part like any other.
    """
    spark = session(docs.sparkSession)
    text = body()
    nodes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
                        F.xxhash64(text).alias("h"))
    # rows without doc_id differ by their place in the input; a null adds nothing to the hash of the others
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    nodes = written(nodes.withColumn("luck", F.xxhash64("doc_id", "h", place)), "nodes")
    total = nodes.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    quota = spark.createDataFrame(list(enumerate(quotas)), "shard int, quota long")
    group = ["h", "crc", "size"]
    sizes = nodes.groupBy(*group).agg(F.count("*").alias("n")).where("n > 1")
    most = max(1, total // (shards * PART))
    nodes = written(nodes.join(sizes, group, "left"), "grouped")                    # n: null for documents without links
    # large groups: at most PART a shard, so their plan is a small table
    large = nodes.where(F.col("n") > most).groupBy(*group).agg(F.first("n").alias("n")).orderBy(F.desc("n"), *group).collect()
    chosen, left = [], list(quotas)
    for g, parts in zip(large, _choose([g.n for g in large], quotas)):
        at = 0
        for s, n in parts:
            chosen.append((g.h, g.crc, g.size, at, at + n, s))
            at, left[s] = at + n, left[s] - n
    chosen = spark.createDataFrame(chosen, "h long, crc long, size long, lo long, hi long, shard int")
    held = _ranked(nodes.where(F.col("n") > most), group, F.xxhash64("luck", F.lit(2)), max(1, total // PER_BUCKET), "nth")
    held = held.join(F.broadcast(chosen), group).where((F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")))
    # the others start at random in the room that is left
    upto = F.array(*[F.lit(sum(left[:s + 1])).cast("double") for s in range(shards)])
    spot = F.shiftrightunsigned(F.xxhash64("luck", F.lit(1)), 11) / F.lit(float(2**53)) * F.lit(float(sum(left)))
    start = F.least(F.size(F.filter(upto, lambda e: e <= spot)), F.lit(max([s for s in range(shards) if left[s]], default=0))).cast("int")
    linked = nodes.where((F.col("n") > 1) & (F.col("n") <= most)).withColumn("start", start)
    ends = _propagate(linked.groupBy(*group, "start").agg(F.count("*").alias("n")), left, rounds)
    linked = linked.join(ends, [*group, "start"])

    # tied: 0 without links, 1 in a group that one task can order, 2 in a larger one
    columns = ["doc_id", "size", "crc", "h", "luck", "shard"]
    tied = F.when(F.col("n") > F.least(F.lit(most), F.lit(PER_BUCKET)), F.lit(2)).otherwise(F.lit(1)).alias("tied")
    placed = held.select(*columns, tied).unionByName(linked.select(*columns, tied))
    placed = written(placed.unionByName(nodes.where("n is null").withColumn("shard", start).select(*columns, F.lit(0).alias("tied"))), "placed")
    buckets = max(1, -(-total // (shards * PER_BUCKET)))
    count = lambda k: F.count(F.when(F.col("tied") == k, 1))
    counts = placed.groupBy("shard").agg(F.count("*").alias("load"), count(0).alias("loose"), count(1).alias("small"))
    counts = quota.join(F.broadcast(counts), "shard", "left").na.fill(0, ["load", "loose", "small"])
    by_shard = Win.orderBy("shard").rowsBetween(Win.unboundedPreceding, -1)            # a table of one row a shard
    over, under = F.greatest(F.col("load") - F.col("quota"), F.lit(0)), F.greatest(F.col("quota") - F.col("load"), F.lit(0))
    plan = counts.select("shard", "loose", "small", over.alias("over"), under.alias("under"), F.coalesce(F.sum(over).over(by_shard), F.lit(0)).alias("over_before"),
                         F.coalesce(F.sum(under).over(by_shard), F.lit(0)).alias("under_before"))
    plan = written(plan, "plan")
    # surplus rows of a shard: first those without links, then linked ones, group by group
    order = F.when(F.col("tied") == 1, F.xxhash64("h", "crc", "size")).otherwise(F.xxhash64("luck", F.lit(3)))
    ranked = _ranked(placed, ["shard", "tied"], order, buckets, "nth").join(F.broadcast(plan), "shard")
    nth = F.col("nth") + F.when(F.col("tied") > 0, F.col("loose")).otherwise(0) + F.when(F.col("tied") > 1, F.col("small")).otherwise(0)
    ranked = ranked.withColumn("leaves", F.when(nth < F.col("over"), F.col("over_before") + nth))
    goals = plan.where("under > 0").select(F.col("shard").alias("goal"), F.col("under_before").alias("lo"), (F.col("under_before") + F.col("under")).alias("hi"))
    moved = ranked.join(F.broadcast(goals), (F.col("leaves") >= F.col("lo")) & (F.col("leaves") < F.col("hi")), "left")
    final = written(moved.select("doc_id", "size", "crc", "luck", F.coalesce("goal", "shard").alias("shard")), "sharded")
    final = _ranked(final, ["shard"], F.xxhash64("luck", F.lit(4)), buckets, "slot")
    return final.select("doc_id", "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("long").alias("slot"))
