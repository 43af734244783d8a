"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of distinct five-word shingles, 336 MinHash codes of one byte and a digest of the set. Documents
   with equal sets are one class, handled by its smallest member from here on.
2. 56 bands of six codes give buckets. A document's first candidates are the smallest members of its buckets, one a round: the one
   it shares most buckets with and is not yet in a component with. A large group of near copies thus takes a pair or two a document.
3. A pair is compared code batch by code batch. After each batch the posterior of its similarity (uniform prior) decides: a pair
   whose chance of reaching the threshold is below ``MISS`` goes. Survivors are confirmed on their full shingle sets.
4. Links make components. Buckets that then still hold several components are compared in full across components, so that every
   candidate pair that could join two components is decided; pairs within a component need no comparison. This happens in blocks
   of a bucket, on longer signatures that only these documents get (near misses are many there), and in two passes: the first names the
   members with a likely partner, a row each; the second gets their texts and confirms likely pairs inside the block, best match first,
   until no two of its components are left that a likely pair joins. So at most one link a member leaves a block, never its pairs.

At a similarity of exactly 0.75 a pair shares no band with probability (1 - 0.75**6)**56 < 0.00002, and less above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .shared import maybe_among, text_rows, written

SHINGLE = 5
BANDS, ROWS = 56, 6
HASHES = BANDS * ROWS
ROUNDS = 2                  # of one candidate a document, before buckets are compared in full
LONG = 4 * HASHES           # codes of documents whose buckets are compared in full
BLOCK = 1000                # members of a bucket compared in one piece
FEW_MINOR, SMALL_BLOCK = 100, 200          # with at most so many minor members: members of a piece
BLOCK_BYTES = 8 << 20       # text of a piece
STEPS = (*range(48, HASHES + 1, 48), 2 * HASHES, 3 * HASHES, LONG)          # codes compared when a pair is judged
MISS = 1e-5                 # chance, after each step, of dropping a pair that reaches the threshold
PERCENT = 75
SIGN_BYTES = 512 << 10

SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("codes", pa.binary())])


def _multipliers(n: int) -> np.ndarray:
    return (W.mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of five-word shingles of each text; fewer words give one hash, no words none."""
    hashed, counts = W.hash_words([t.translate(W.LOWER) for t in texts])
    rolled = W.window_hashes(hashed, SHINGLE)
    out, at = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            out.append(np.unique(rolled[at:at + n - SHINGLE + 1]))
        else:
            out.append(W.window_hashes(hashed[at:at + n], n) if n else np.zeros(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray], n: int = HASHES) -> np.ndarray:
    """``n`` MinHash codes (one byte each) of non-empty sets, one row a set."""
    start = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), n), np.uint8)
    for k, m in enumerate(_multipliers(n)):
        least = np.minimum.reduceat(values * m, start)
        out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def _sign(batches):
    for rows in W.gather(batches, SIGN_BYTES, 4000):
        sets = shingle_sets([r[2] for r in rows])
        full = [i for i, s in enumerate(sets) if len(s)]
        codes: list[bytes | None] = [None] * len(rows)
        digest = [(0, 0)] * len(rows)
        if full:
            for i, c in zip(full, signatures([sets[i] for i in full])):
                s = sets[i]
                codes[i] = c.tobytes()
                digest[i] = tuple(int(x) for x in np.array([W.mix(s).sum(), np.bitwise_xor.reduce(W.mix(s + np.uint64(77)))], np.uint64).view(np.int64))
        columns = [[r[0] for r in rows], [len(s) for s in sets], [d[0] for d in digest], [d[1] for d in digest], codes]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SIGNED)], schema=SIGNED)


def _bands(batches):
    for b in batches:
        if not b.num_rows:
            continue
        ids = b.column(0).to_numpy(zero_copy_only=False)
        codes = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, BANDS, ROWS)
        wide = np.zeros((len(ids), BANDS, 8), np.uint8)
        wide[:, :, :ROWS] = codes
        wide[:, :, ROWS] = np.arange(BANDS, dtype=np.uint8)
        for i in range(0, len(ids), 500):
            yield pa.RecordBatch.from_arrays([pa.array(wide[i:i + 500].reshape(-1, 8).copy().view("<i8").ravel()), pa.array(np.repeat(ids[i:i + 500], BANDS))],
                                             names=["key", "id"])


@lru_cache
def fewest_matches(miss: float = MISS, percent: int = PERCENT) -> tuple[tuple[int, int], ...]:
    """For each number of codes compared: the fewest equal ones at which similarity >= percent still has a chance of ``miss``."""
    grid = (np.arange(4000) + 0.5) / 4000
    p = grid + (1 - grid) / 256                      # two codes of one byte also agree by chance
    out = []
    for m in STEPS:
        x = np.arange(m + 1)[:, None]
        log = x * np.log(p) + (m - x) * np.log1p(-np.minimum(p, 1 - 1e-12))
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        chance = weight[:, grid >= percent / 100].sum(axis=1) / weight.sum(axis=1)
        out.append((m, int(np.argmax(chance >= miss))))
    return tuple(out)


def _sequential(batches):
    """Drop pairs as soon as the posterior says so."""
    steps = [x for x in fewest_matches() if x[0] <= HASHES]
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        left, right = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(n, HASHES) for i in (2, 3))
        alive, equal, done = np.arange(n), np.zeros(n, np.int64), 0
        for m, least in steps:
            equal = equal + (left[alive, done:m] == right[alive, done:m]).sum(axis=1)
            done = m
            stay = equal >= least
            alive, equal = alive[stay], equal[stay]
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(alive)), b.column(1).take(pa.array(alive))], names=["a", "b"])


def _sign_long(with_body: bool):
    """Long signatures of (doc_id, body) rows, with the text itself if asked for."""
    def run(batches):
        for rows in W.gather(batches, SIGN_BYTES, 4000):
            some = [(r, x) for r, x in zip(rows, shingle_sets([r[1] for r in rows])) if len(x)]
            codes = signatures([x for _, x in some], LONG) if some else []
            columns = [pa.array([r[0] for r, _ in some], pa.int64()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([r[1] for r, _ in some], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns[:2 + with_body], names=["id", "codes", "body"][:2 + with_body])
    return run


def _cells(batches) -> Iterator[list[tuple]]:
    """Rows of one cell after another; they come sorted by the first three columns."""
    now, out = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:3] != now:
                if out:
                    yield out
                now, out = row[:3], []
            out.append(row)
    if out:
        yield out


def _likely_in(rows: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
    """For each member of a minor component (left) of a cell the members (right, best match first) it is likely linked with.

    A pair that meets in several buckets is seen by the first band it agrees in, two minor members from one side only.
    """
    steps = fewest_matches()
    band = (rows[0][0] >> 48) & 0xFF
    right = [r for r in rows if not r[3]]
    if not right or len(right) == len(rows):
        return
    codes = np.frombuffer(b"".join(r[7] for r in right), np.uint8).reshape(len(right), LONG)
    ids, roots, minor = (np.array([r[i] for r in right]) for i in (4, 5, 6))
    for at, row in enumerate(rows):
        if not row[3]:
            continue
        own = np.frombuffer(row[7], np.uint8)
        alive = np.flatnonzero((roots != row[5]) & (~minor | (ids > row[4])))
        equal, done = np.zeros(len(alive), np.int64), 0
        for m, least in steps:
            if not len(alive):
                break
            equal = equal + (codes[alive, done:m] == own[done:m]).sum(axis=1)
            done, stay = m, equal >= least
            alive, equal = alive[stay], equal[stay]
        if len(alive):
            agree = (codes[alive, :HASHES] == own[:HASHES]).reshape(-1, BANDS, ROWS).all(axis=2)
            mine = agree.argmax(axis=1) == band
            alive, equal = alive[mine], equal[mine]
            if len(alive):
                yield at, alive[np.argsort(-equal, kind="stable")]


def _meeting(batches):
    """Members of each cell with a likely partner: a row a member, whatever the number of its partners."""
    key, member = [], []
    for rows in _cells(batches):
        right = [r[4] for r in rows if not r[3]]
        found: set[int] = set()
        for at, partners in _likely_in(rows):
            found.add(rows[at][4])
            found.update(right[i] for i in partners.tolist())
        key += [rows[0][0]] * len(found)
        member += found
        if len(key) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(member, pa.int64())], names=["key", "id"])
            key, member = [], []
    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(member, pa.int64())], names=["key", "id"])


AT_ONCE = 32                # likely partners of a member confirmed together


def _decide(batches):
    """Links of each cell that join its components: likely pairs, best first, are confirmed on their full sets until no two
    components are left that a likely pair joins. Fewer rows than members leave a cell; pairs that its links join already need no check.
    """
    for rows in _cells(batches):
        right = [r for r in rows if not r[3]]
        sets: dict[bytes, np.ndarray] = {}
        above: dict[int, int] = {}

        def shingles(text: bytes) -> np.ndarray:
            if text not in sets:
                sets[text] = shingle_sets([text])[0]
            return sets[text]

        def root(x: int) -> int:
            while above.get(x, x) != x:
                above[x] = x = above.get(above[x], above[x])
            return x

        a, b = [], []
        for at, partners in _likely_in(rows):
            row, left = rows[at], partners.tolist()
            mine = shingles(row[8])
            while left:
                left = [i for i in left if root(right[i][5]) != root(row[5])]
                now, left = left[:AT_ONCE], left[AT_ONCE:]
                if not now:
                    break
                others = [shingles(right[i][8]) for i in now]
                flat, size = np.concatenate(others), np.array([len(o) for o in others])
                hit = np.concatenate([[0], np.cumsum(mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat)]) if len(mine) else np.zeros(len(flat) + 1)
                common = np.diff(hit[np.concatenate([[0], np.cumsum(size)])])
                for i in np.flatnonzero(100 * common >= PERCENT * (len(mine) + size - common)).tolist():
                    other = right[now[i]]
                    if len(mine) and root(other[5]) != root(row[5]):
                        above[root(other[5])] = root(row[5])
                        a.append(min(row[4], other[4]))
                        b.append(max(row[4], other[4]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


REMEMBERED = 4 << 20        # shingles that a task remembers


def _confirm(batches):
    """Pairs whose full shingle sets overlap enough. Sets of documents that come again are remembered, up to a bound."""
    known: dict[bytes, np.ndarray] = {}
    size = 0

    def shingles(text: bytes) -> np.ndarray:
        nonlocal size
        if text not in known:
            if size > REMEMBERED:
                known.clear()
                size = 0
            known[text] = shingle_sets([text])[0]
            size += len(known[text]) + len(text) // 8
        return known[text]

    for batch in batches:
        keep = []
        for i, (a, b, left, right) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            mine, other = shingles(left), shingles(right)
            if len(mine) > len(other):
                mine, other = other, mine
            if not len(mine):
                continue
            common = int((other[np.minimum(np.searchsorted(other, mine), len(other) - 1)] == mine).sum())
            if 100 * common >= PERCENT * (len(mine) + len(other) - common):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], names=["a", "b"])


def _texts(rows: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """The different texts of the given documents."""
    return written(maybe_among(rows, ids).join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "tid"]).select("doc_id", "body"), f"{label}-texts", free=True)


def _likely(pairs: DataFrame, codes: DataFrame, label: str) -> DataFrame:
    """Those of the pairs (a, b) that their codes do not rule out."""
    side = lambda x: codes.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("codes").alias(f"c{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    return written(both.select("a", "b", "ca", "cb").mapInArrow(_sequential, "a long, b long").distinct(), f"{label}-likely", few=True)


def _links(likely: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """Those of the pairs that are links by their full sets."""
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("body").alias(f"t{x}"))
    full = likely.join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb")
    return written(full.mapInArrow(_confirm, "a long, b long").distinct(), f"{label}-links", few=True)


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def _in_cells(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Cells of the buckets of ``placed`` (key, id, root, main: the largest component) with the columns of ``members`` (id, codes, ...).

    Members of minor components (left) meet all members (right) in cells of at most BLOCK by BLOCK (or BLOCK_BYTES of text), so no bucket
    lands in one task. Where few are minor, cells are small: only the few are repeated.
    """
    minor = F.col("root") != F.col("main")
    weight = F.octet_length("body") if "body" in members.columns else F.lit(0)
    rows = placed.join(members, "id").withColumn("minor", minor)
    parts = lambda n, size: F.greatest(F.lit(1), F.ceil(n), F.ceil(size / F.lit(BLOCK_BYTES))).cast("int")
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(weight).alias("size"), F.count_if("minor").alias("few"), F.sum(F.when(F.col("minor"), weight)).alias("less"))
    sizes = sizes.where("few > 0").select("key", parts(F.col("n") / F.when(F.col("few") <= FEW_MINOR, SMALL_BLOCK).otherwise(BLOCK), F.col("size")).alias("blocks"),
                                          parts(F.col("few") / BLOCK, F.coalesce("less", F.lit(0))).alias("lefts"))
    rows = rows.join(sizes, "key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    left = rows.where("minor").withColumn("i", own("lefts", 1)).withColumn("j", every("blocks")).withColumn("side", F.lit(True))
    right = rows.withColumn("j", own("blocks", 2)).withColumn("i", every("lefts")).withColumn("side", F.lit(False))
    more = [c for c in members.columns if c != "id"]
    cells = left.unionByName(right).select("key", "i", "j", "side", "id", "root", "minor", *more)
    return cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _links_across(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components, for buckets that hold several: enough of them to join all that any likely pair joins."""
    long = written(texts.mapInArrow(_sign_long(False), "id long, codes binary"), "long")
    meeting = written(_in_cells(placed, long).mapInArrow(_meeting, "key long, id long").distinct(), "meeting", few=True)
    some = texts.join(meeting.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    full = written(some.mapInArrow(_sign_long(True), "id long, codes binary, body binary"), "full")
    found = _in_cells(placed.join(meeting, ["key", "id"], "left_semi"), full).mapInArrow(_decide, "a long, b long")
    return written(found.distinct(), "last-links", free=True)


def _tree(roots: DataFrame) -> DataFrame:
    """Components so far as links."""
    return roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``; only ``doc_id`` and ``text`` are read.

    Documents are linked when their sets of five-word shingles have a similarity of 0.75 or more; ``component_id`` is the
    smallest doc_id reachable by links. Null, empty and blank texts have no shingles and no links. A row without doc_id is
    linked with nothing: its component is null and it is kept. Rows that repeat a doc_id are one node with the links of each.
    """
    rows = text_rows(docs)
    signed = written(rows.select("doc_id", "tid", "body").mapInArrow(_sign, "doc_id long, n long, d1 long, d2 long, codes binary"), "signed")
    some = signed.where("n > 0 and doc_id is not null")
    classes = written(some.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep")), "classes", few=True)
    codes = some.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "n", "d1", "d2"], "left_semi").select("doc_id", "n", "codes").distinct()
    codes = written(codes, "codes")

    banded = codes.select("doc_id", "codes").mapInArrow(_bands, "key long, id long")
    shared = banded.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    buckets = written(banded.join(shared.select("key", "low"), "key"), "buckets", free=True)
    votes = buckets.where("id <> low").groupBy(F.col("low").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("n"))
    votes = written(votes, "votes", few=True)

    # a doc_id with several texts ties their classes together
    members = some.join(classes, ["n", "d1", "d2"]).select("doc_id", "rep")
    tied = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "doc_id")
    tied = tied.join(members, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))
    links, tested = written(tied.distinct(), "tied", few=True), None
    roots = components(links)
    for r in range(ROUNDS):
        side = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        apart = votes.join(side("a"), "a", "left").join(side("b"), "b", "left").where("coalesce(ra, a) <> coalesce(rb, b)")
        if tested is not None:
            apart = apart.join(tested, ["a", "b"], "left_anti")
        best = written(apart.groupBy("b").agg(F.max(F.struct("n", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b"), f"best-{r}", few=True)
        if best.isEmpty():
            break
        tested = best if tested is None else tested.unionByName(best)
        likely = _likely(best, codes, f"round-{r}")
        more = _links(likely, _texts(rows, _ids(likely), f"round-{r}"), f"round-{r}")
        roots = components(_tree(roots).unionByName(more))

    placed = buckets.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", -F.col("root"))).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    placed = written(placed.join(mixed.select("key", "main"), "key"), "placed", few=True)
    if not placed.isEmpty():
        texts = _texts(rows, placed.select(F.col("id").alias("doc_id")).distinct(), "last")
        roots = components(_tree(roots).unionByName(_links_across(placed, texts)))

    found = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("root"))
    out = signed.select("doc_id", "n").join(found, "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
