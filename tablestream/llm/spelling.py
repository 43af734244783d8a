"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One inserted or deleted letter changes one letter count by one, one replaced letter changes two counts by one each. So words one edit apart
have count vectors at an L1 distance of at most two, and only the length pairs (n, n) and (n, n + 1) can hold them.

1. Words are counted over the whole corpus.
2. Words of a length that is too big for one task are cut by the top of a k-d tree, built from a bounded sample; its leaves are boxes that
   fill the space, so every word has one box, its own. A word also travels, as a query, to the boxes of its length (each pair of boxes from
   one side only) and of the next length that its radius reaches.
3. In each box a k-d tree over the count vectors of the box's words answers its queries: boxes out of reach are pruned, words left are
   compared by counts, and what is still left by the order of their letters. Only counts and best neighbours leave the task, no pairs.
4. Forms are followed to the last one by pointer doubling.

Count vectors are kept as bits ("letter c occurs t times or more"): the L1 distance of two words is the number of different bits, the
distance to a box the number of bits its least vector has and the word lacks plus those the word has and its largest vector lacks.
Letters share ``SLOTS`` counts and a count ends at ``LEVELS``; both only make distances smaller, so nothing is missed.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .ragged import starts_of
from .shared import session, text_rows, written

LEAST, TWICE, RATIO, ONE_IN = 7, 2, 10, 31
SLOTS, LEVELS = 64, 4
LANES = SLOTS * LEVELS // 64
LEAF = 24                           # words of a leaf of the tree within a box
BOX_WORDS = 20_000                  # words of a box, about
SAMPLED = 16                        # words sampled for each box
QUERIES, PAIRS = 4096, 1 << 20      # queries walked at once, pairs compared at once
HELD = 300_000                      # different words counted in a task before they are sent on


# ---- words of the corpus ------------------------------------------------------------------------------

def _tally(least: int, one_in: int) -> Callable:
    run_of = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def run(batches):
        held: dict[str, int] = {}
        for rows in W.gather(batches, 1 << 20):
            for doc, body in rows:
                start = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                for word, n in Counter(run_of.findall(body.translate(W.LOWER).decode("utf-8", "replace"))).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    held[word] = held.get(word, 0) + n
            if len(held) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
                held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
    return run


def corpus_words(docs: DataFrame, least: int = LEAST, twice: int = TWICE, one_in: int = ONE_IN, text: str = "text") -> DataFrame:
    """``word, n`` of all texts: runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, of ``least`` letters and ``twice`` times at least.

    Where ``one_in`` divides the crc32 of ``<doc_id>:<run>``, the run loses its letter number crc32 % length before it is counted; a null
    doc_id counts as an empty one. Null texts have no words; rows that repeat count each time.
    """
    found = text_rows(docs, text).select("doc_id", "body").mapInArrow(_tally(least, one_in), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= twice)


# ---- letter counts and trees -------------------------------------------------------------------------------

def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)


def count_bits(points: np.ndarray) -> np.ndarray:
    """Letter counts as bits, ``LANES`` 64-bit words a row."""
    out = np.zeros((len(points), LANES), np.uint64)
    for i in range(0, len(points), 1 << 14):
        part = points[i:i + (1 << 14)]
        counts = np.zeros((len(part), SLOTS), np.uint8)
        rows = np.arange(len(part))
        for column in (part & (SLOTS - 1)).T:
            counts[rows, column] += counts[rows, column] < LEVELS
        bits = counts[:, :, None] > np.arange(LEVELS, dtype=np.uint8)
        out[i:i + len(part)] = np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little").view(np.uint64)
    return out


def _best_bit(codes: np.ndarray) -> tuple[int, np.ndarray] | None:
    """The count that cuts the vectors most evenly and which of them have it; none if all are equal."""
    bits = np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little")
    have = bits.sum(axis=0, dtype=np.int64)
    bit = int(np.argmin(np.abs(2 * have - len(codes))))
    return None if have[bit] in (0, len(codes)) else (bit, bits[:, bit].astype(bool))


class KdTree:
    """Nodes as flat arrays. ``low`` and ``high``: least and largest vector of a node; leaves have ``first`` and ``size`` in ``order``."""

    def __init__(self, codes: np.ndarray, leaf: int = LEAF, whole_space: bool = False):
        self.order = np.arange(len(codes))
        low, high, left, first, size = [], [], [], [], []

        def node(a: int, z: int, lo: np.ndarray, hi: np.ndarray) -> int:
            if not whole_space:
                part = codes[self.order[a:z]]
                lo, hi = np.bitwise_and.reduce(part, axis=0), np.bitwise_or.reduce(part, axis=0)
            for column, x in ((low, lo), (high, hi), (left, -1), (first, a), (size, z - a)):
                column.append(x)
            return len(low) - 1

        self.split: list[int] = []
        todo = [node(0, len(codes), np.zeros(LANES, np.uint64), np.full(LANES, ~np.uint64(0)))]
        while todo:
            at = todo.pop()
            a, n = first[at], size[at]
            cut = _best_bit(codes[self.order[a:a + n]]) if n > leaf else None
            self.split += [-1] * (at + 1 - len(self.split))
            if cut is None:
                continue
            bit, has = cut
            part = self.order[a:a + n]
            self.order[a:a + n] = np.concatenate([part[~has], part[has]])
            m = a + n - int(has.sum())
            one = np.zeros(LANES, np.uint64)
            one[bit // 64] = np.uint64(1) << np.uint64(bit % 64)
            left[at] = node(a, m, low[at], high[at] & ~one)
            node(m, a + n, low[at] | one, high[at])
            self.split[at] = bit
            todo += [left[at], left[at] + 1]
        self.split += [-1] * (len(low) - len(self.split))
        self.low, self.high = np.array(low, np.uint64).reshape(-1, LANES), np.array(high, np.uint64).reshape(-1, LANES)
        self.left, self.first, self.size = (np.array(x, np.int64) for x in (left, first, size))

    def reach(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, leaf) with the query at most ``radius`` from the leaf's box."""
        query, at = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        found_q, found_l = [], []
        while len(query):
            own, away = codes[query], np.zeros(len(query), np.int64)
            for lane in range(LANES):
                away += np.bitwise_count(self.low[at, lane] & ~own[:, lane]) + np.bitwise_count(own[:, lane] & ~self.high[at, lane]).astype(np.int64)
            near = away <= radius
            query, at = query[near], at[near]
            leaf = self.left[at] < 0
            found_q.append(query[leaf])
            found_l.append(at[leaf])
            query, at = query[~leaf], self.left[at[~leaf]]
            query, at = np.concatenate([query, query]), np.concatenate([at, at + 1])
        return (np.concatenate(found_q), np.concatenate(found_l)) if found_q else (query, at)

    def home(self, codes: np.ndarray) -> np.ndarray:
        """The leaf whose part of the space a vector lies in (trees of the whole space)."""
        at = np.zeros(len(codes), np.int64)
        split = np.array(self.split)
        for _ in range(len(split)):
            bit = split[at]
            if (bit < 0).all():
                break
            has = (codes[np.arange(len(codes)), np.maximum(bit, 0) // 64] >> (np.maximum(bit, 0) % 64).astype(np.uint64)) & np.uint64(1)
            at = np.where(bit < 0, at, self.left[at] + has.astype(np.int64))
        return at

    def candidates(self, codes: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word) pairs within the radius, in parts of bounded size."""
        for i in range(0, len(queries), QUERIES):
            q, leaf = self.reach(queries[i:i + QUERIES], radius)
            q = q + i
            size = self.size[leaf]
            done = np.cumsum(size)
            a = 0
            while a < len(q):
                z = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + PAIRS, "right")))
                many = size[a:z]
                left = np.repeat(q[a:z], many)
                right = self.order[np.repeat(self.first[leaf[a:z]] - starts_of(many), many) + np.arange(many.sum())]
                for b in range(0, len(left), PAIRS):         # one leaf of equal vectors may be bigger
                    x, y = left[b:b + PAIRS], right[b:b + PAIRS]
                    away = np.zeros(len(x), np.int64)
                    for lane in range(LANES):
                        away += np.bitwise_count(queries[x, lane] ^ codes[y, lane])
                    yield x[away <= radius], y[away <= radius]
                a = z


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of code points that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows where the longer word is the shorter one with one letter more."""
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= short.shape[1]


# ---- boxes and their work -----------------------------------------------------------------------------------

def _tops(words: DataFrame, box_words: int) -> dict[int, KdTree]:
    """Tops of the trees of the lengths with more words than one box takes (fewer of long words), from ``SAMPLED`` words a box."""
    length = F.length("word").alias("length")
    boxes = F.ceil(F.col("count") * F.greatest(F.col("length"), F.lit(16)) / (16 * box_words)).cast("int")
    big = words.groupBy(length).count().withColumn("boxes", boxes).where("boxes > 1").collect()       # few: each has a box full of words
    if not big:
        return {}
    by_length = lambda name: F.create_map(*[F.lit(x) for r in big for x in (r.length, r[name])])[F.length("word")]
    luck = F.pmod(F.xxhash64("word", F.lit(5)), F.lit(1 << 30))
    sample: dict[int, list[str]] = {}
    for r in words.where(luck < by_length("boxes") * float(SAMPLED << 30) / by_length("count")).select("word").collect():
        sample.setdefault(len(r.word), []).append(r.word)
    return {n: KdTree(count_bits(letters(sorted(found))), SAMPLED, whole_space=True) for n, found in sample.items()}


DEALT = pa.schema([("length", pa.int32()), ("box", pa.int32()), ("own", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])


def _deal(tops: dict[int, KdTree]) -> Callable:
    def boxes(n: int, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        return tops[n].reach(codes, radius) if n in tops else (np.arange(len(codes)), np.zeros(len(codes), np.int64))

    def run(batches):
        for b in batches:
            words, counts = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            lengths = np.array([len(w) for w in words], np.int64)
            for n in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == n)
                codes = count_bits(letters([words[i] for i in rows.tolist()]))
                home = tops[n].home(codes) if n in tops else np.zeros(len(rows), np.int64)
                same, box = boxes(n, codes, 2)
                later = box > home[same]
                longer, above = boxes(n + 1, codes, 1)
                who = rows[np.concatenate([np.arange(len(rows)), same[later], longer])]
                to = np.concatenate([home, box[later], above])
                size = np.where(np.arange(len(who)) < len(rows) + later.sum(), n, n + 1)
                own = np.arange(len(who)) < len(rows)
                for i in range(0, len(who), 50_000):
                    s = slice(i, i + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(size[s], pa.int32()), pa.array(to[s], pa.int32()), pa.array(own[s]),
                                                      b.column(0).take(pa.array(who[s])).cast(pa.string()), pa.array(counts[who[s]], pa.int64())], schema=DEALT)
    return run


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])


def _search(table: pa.Table) -> pa.Table:
    """Near words of a box's words and queries: for each word how many, and the one of largest n (of equals the least)."""
    words, counts = np.array(table.column("word").to_pylist(), object), table.column("n").to_numpy()
    own = table.column("own").to_numpy()
    length = table.column("length")[0].as_py()
    size = np.array([len(w) for w in words])
    mine = np.flatnonzero(own)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    if len(mine):
        rank = np.empty(len(words), np.int64)                # larger n first, then the least word
        by_word = np.argsort(words, kind="stable")
        rank[by_word[np.argsort(-counts[by_word], kind="stable")]] = np.arange(len(words), 0, -1)
        points = letters(words[mine].tolist())
        codes = count_bits(points)
        tree = KdTree(codes)

        def meet(rows: np.ndarray, own_points: np.ndarray, own_codes: np.ndarray, radius: int, check: Callable, once: bool) -> None:
            for x, y in tree.candidates(codes, own_codes, radius):
                if once:                                     # both words are of this box: each pair from one side
                    x, y = x[x < y], y[x < y]
                step = max(1, 16 * PAIRS // max(length, 1))  # long words: fewer pairs at once
                for i in range(0, len(x), step):
                    good = check(own_points[x[i:i + step]], points[y[i:i + step]])
                    a, b = rows[x[i:i + step][good]], mine[y[i:i + step][good]]
                    for p, q in ((a, b), (b, a)):
                        np.add.at(near, p, 1)
                        np.maximum.at(best, p, rank[q])

        meet(mine, points, codes, 2, one_replaced, True)
        for n, radius, check in ((length, 2, one_replaced), (length - 1, 1, one_inserted)):
            rows = np.flatnonzero(~own & (size == n))
            for i in range(0, len(rows), 20_000):
                part = rows[i:i + 20_000]
                p = letters(words[part].tolist())
                meet(part, p, count_bits(p), radius, check, False)
        back = np.empty(len(words) + 1, np.int64)
        back[rank] = np.arange(len(words))
    met = np.flatnonzero(near)
    if not len(met):
        return NEAR.empty_table()
    with_best = back[best[met]]
    return pa.Table.from_arrays([pa.array(words[met], pa.string()), pa.array(near[met]), pa.array(words[with_best], pa.string()), pa.array(counts[with_best])], schema=NEAR)


def near_words(words: DataFrame, box_words: int = BOX_WORDS) -> DataFrame:
    """``word, n_near, best, best_n`` for every word of ``words`` (``word``, ``n``; distinct, not null) with another one edit away."""
    session(words.sparkSession)
    tops = _tops(words, box_words)
    dealt = words.select("word", "n").mapInArrow(_deal(tops), "length int, box int, own boolean, word string, n long")
    found = dealt.groupBy("length", "box").applyInArrow(_search, "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.best", (-F.col("b.less")).alias("best_n"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, box_words: int = BOX_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word``, ``n``: distinct words and how often they occur).

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word of largest n (ties: least in
    code-point order) if that is ``ratio`` times the word's n at least, else null; root is the last form on the way from form to form
    (a form is always more frequent, so every way ends). Null words and words that stand twice are taken out first (the largest n stays).
    """
    words = words.select("word", "n").where("word is not null").groupBy("word").agg(F.max("n").alias("n"))
    words = written(words, "words")
    near = written(words.join(near_words(words, box_words), "word", "left"), "near")
    form = F.col("best_n") >= ratio * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n"))
    step = written(near.where("form is not null").select("word", F.col("form").alias("root")), "forms", few=True)
    while True:                                              # pointer doubling: a way of d forms takes log2(d) rounds
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms", few=True)
        if moved.where("moved").isEmpty():
            break
        step = moved.drop("moved")
    return near.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
