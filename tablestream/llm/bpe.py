"""Byte-level BPE: ids of whole texts by corpus-level merge replay, and texts from ids.

1. Every text is cut into pieces (letters with a space before them, digits, marks, white space; English contractions), in numpy over
   the classes of its code points, and pieces go by a 64-bit hash of their bytes.
2. The pieces of the whole corpus are counted. The ``DICTIONARY`` most frequent ones, a bound that does not grow with the corpus, are
   replayed on the cluster once (``merges``: an inverted index from pair to places, merges in rank order) and travel with the tasks.
3. One pass over the texts takes each block's distinct pieces from the dictionary or from what the task remembers; all new pieces of a
   block are replayed together. Pieces do not touch one another, so it does not matter which are replayed together.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .merges import SHIFT, Merges
from .ragged import Remembered, binary_rows, list_rows, starts_of, take_runs
from .shared import text_rows

BLOCK = 4 << 20                     # bytes of text whose pieces are looked up together
CHUNK = 1 << 20                     # code points that are cut at once
DICTIONARY, LONGEST = 1 << 18, 64   # pieces of the dictionary, bytes of the longest among them
REMEMBERED = 1 << 20                # pieces of each generation a task remembers
SENT = 4 << 20                      # ids in one Arrow batch
LETTER, DIGIT, OTHER, SPACE = range(4)

# Letters and numbers (code points, hexadecimal) newer than Unicode 16, which the tokenizer library takes for other marks.
NEWER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""


@lru_cache
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    shift = lambda i: i if i < 0xD800 else i + 0x800
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            for a, b in ((m.start(), min(m.end(), 0xD800)), (max(m.start(), 0xD800), m.end())):
                if a < b:
                    out[shift(a):shift(b - 1) + 1] = kind
    for span in NEWER.split():
        first, _, last = span.partition("-")
        out[int(first, 16):int(last or first, 16) + 1] = OTHER
    return out


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces begin in the code points of several texts; ``first``: where each text begins.

    A piece is a run of letters, digits or other marks with the one space before it; a run of white space gives its last character to
    what follows (a piece of its own unless it is a space), unless the text ends with it. A lone apostrophe not after a space takes
    s, t, m, d, re, ve or ll from the letters after it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    border = np.zeros(n + 1, bool)
    border[first] = border[n] = True
    edge = border[:n].copy()
    edge[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(edge)
    end, kinds = np.append(run[1:], n), kind[run]
    space = np.flatnonzero((kinds == SPACE) & ~border[end])
    last = end[space] - 1
    edge[last] = True
    edge[end[space[points[last] == 0x20]]] = False
    lone = np.flatnonzero((kinds == OTHER) & (end - run == 1))
    lone = lone[(points[run[lone]] == 0x27) & edge[run[lone]] & ~border[end[lone]]]
    lone = lone[kinds[np.minimum(lone + 1, len(run) - 1)] == LETTER]
    a, z = run[lone + 1] if len(lone) else lone, end[lone + 1] if len(lone) else lone
    one = points[a]
    two = np.where(a + 1 < z, points[np.minimum(a + 1, n - 1)], 0)
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(pair, 2, 0))
    edge[a[taken > 0]] = False
    rest = (taken > 0) & (a + taken < z)
    edge[(a + taken)[rest]] = True
    return np.flatnonzero(edge)


def _cut(text: str, first: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of joined texts, where their pieces begin in them, and how many pieces begin before each text (and in all)."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    start = piece_starts(points, first)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return text.encode(), (np.cumsum(width) - width)[start], np.searchsorted(start, np.append(first, len(points)))


def split_pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, start and hash of every piece (pieces follow one another without gaps), and pieces of each text."""
    parts: list[tuple[bytes, np.ndarray]] = []
    counts = np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        if len(texts[i]) > CHUNK:                            # cut in chunks; the last two pieces of one may be unfinished
            text, at, step = texts[i].decode("utf-8", "replace"), 0, CHUNK
            while at < len(text):
                part = text[at:at + step]
                data, start, many = _cut(part, np.zeros(1, np.int64))
                if at + step < len(text):
                    if len(start) < 4:
                        step *= 2
                        continue
                    data, start = data[:start[-2]], start[:-2]
                parts.append((data, start))
                counts[i] += len(start)
                at += len(data.decode())
                step = CHUNK
            i += 1
            continue
        j, size, group = i, 0, []
        while j < len(texts) and size + len(texts[j]) <= CHUNK:
            size += len(texts[j])
            group.append(texts[j].decode("utf-8", "replace"))
            j += 1
        data, start, many = _cut("".join(group), np.cumsum([0] + [len(t) for t in group[:-1]]))
        parts.append((data, start))
        counts[i:j] = np.diff(many)
        i = j
    hashes, starts, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for data, start in parts:
        a = np.frombuffer(data, np.uint8)
        hashes.append(W.span_hashes(a, start, np.append(start[1:], len(a))) if len(start) else np.zeros(0, np.uint64))
        starts.append(start + at)
        at += len(a)
    return np.frombuffer(b"".join(d for d, _ in parts), np.uint8), np.concatenate(starts), np.concatenate(hashes), counts


class Encoder:
    """Ids of texts by the ranks of a file (one line a token: its bytes in base 64, its rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        self.symbols = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.merges = Merges({ranks[t[:i]] << SHIFT | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks})
        order = sorted(ranks.items(), key=lambda x: x[1])
        self.bytes = np.frombuffer(b"".join(t for t, _ in order), np.uint8)
        size = np.zeros(order[-1][1] + 1, np.int64)
        size[[r for _, r in order]] = [len(t) for t, _ in order]
        self.size, self.start = size, starts_of(size)
        self.memory = Remembered(REMEMBERED, np.int32)
        self.dictionary: str | None = None

    def use(self, name: str, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Start from a dictionary, unless this one is in use already."""
        if self.dictionary != name:
            self.memory, self.dictionary = Remembered(REMEMBERED, np.int32), name
            self.memory.add(keys, size, flat)

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and all ids: tokens as they stand, the others by merge replay."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        new = [p for p, r in zip(pieces, whole.tolist()) if r < 0]
        flat, size = self.merges.replay(self.symbols[np.frombuffer(b"".join(new), np.uint8)], np.array([len(p) for p in new], np.int64))
        if len(new) == len(pieces):
            return size, flat
        sizes = np.ones(len(pieces), np.int64)
        sizes[whole < 0] = size
        out = np.empty(int(sizes.sum()), np.int64)
        single = np.repeat(whole >= 0, sizes)
        out[single], out[~single] = whole[whole >= 0], flat
        return sizes, out

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids of all."""
        data, start, hashes, counts = split_pieces(texts)
        end = np.append(start[1:], len(data))
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)

        def compute(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = first[new]
            return self.learn([data[a:z].tobytes() for a, z in zip(start[at].tolist(), end[at].tolist())])
        size, flat = self.memory.rows(keys, compute)
        each, begin = size[which], starts_of(size)[which]
        out = [take_runs(flat, begin[i:i + (1 << 20)], each[i:i + (1 << 20)]) for i in range(0, len(each), 1 << 20)]
        total = np.concatenate([[0], np.cumsum(each)])
        return np.diff(total[np.concatenate([[0], np.cumsum(counts)])]), np.concatenate(out) if out else flat[:0]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id that is no token")
        return take_runs(self.bytes, self.start[ids], self.size[ids])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _default(path: str | None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return path


def _count(batches):
    """Different pieces of each block with their number."""
    for rows in W.gather(batches, BLOCK):
        data, start, hashes, _ = split_pieces([r[0] for r in rows])
        size = np.diff(np.append(start, len(data)))
        short = np.flatnonzero(size <= LONGEST)
        _, first, n = np.unique(hashes[short], return_index=True, return_counts=True)
        at = short[first]
        yield pa.RecordBatch.from_arrays([binary_rows(take_runs(data, start[at], size[at]), size[at]), pa.array(n.astype(np.int64))], names=["piece", "n"])


def count_pieces(docs: DataFrame, text: str = "text") -> DataFrame:
    """``piece`` (bytes, at most ``LONGEST``) and ``n``: how often each piece is in all texts."""
    return text_rows(docs, text).select("body").mapInArrow(_count, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def _replay(path: str) -> Callable:
    def run(batches):
        own = encoder(path)
        for b in batches:
            if b.num_rows:
                size, flat = own.learn(b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), list_rows(flat, size)], names=["piece", "ids"])
    return run


def dictionary(docs: DataFrame, path: str | None = None, most: int = DICTIONARY, text: str = "text") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key (sorted), number of ids and ids of the ``most`` frequent pieces of the corpus (of equally frequent ones the least bytes)."""
    top = count_pieces(docs, text).orderBy(F.col("n").desc(), "piece").limit(most)
    table = top.repartition(8, "piece").select("piece").mapInArrow(_replay(_default(path)), "piece binary, ids array<int>").toArrow()
    pieces, ids = table.column("piece").to_pylist(), table.column("ids").combine_chunks()
    if not pieces:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    size = np.array([len(p) for p in pieces], np.int64)
    start = starts_of(size)
    keys = W.span_hashes(np.frombuffer(b"".join(pieces), np.uint8), start, start + size)
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks)
    n, flat = np.diff(ids.offsets.to_numpy()).astype(np.int64), ids.flatten().to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order], take_runs(flat, starts_of(n)[order], n[order]).astype(np.int32)


def _encode(path: str, name: str, known: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Callable:
    def run(batches):
        own = encoder(path)
        own.use(name, *known)
        for rows in W.gather(batches, BLOCK):
            size, flat = own([r[1] for r in rows])
            start, i = starts_of(size), 0
            while i < len(rows):                             # Arrow batches of bounded size, one row at least
                j = max(i + 1, int(np.searchsorted(start, start[i] + SENT)))
                part = flat[start[i]:start[j - 1] + size[j - 1]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:j]], pa.int64()), pa.array(size[i:j]), list_rows(part, size[i:j])],
                                                 names=["doc_id", "n_tokens", "ids"])
                i = j
    return run


def encode(docs: DataFrame, path: str | None = None, most: int = DICTIONARY, text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row: the ids of its whole text by the ranks in the file ``path``, without special tokens.

    Null and empty texts have no ids. Rows without doc_id and rows that repeat stay, each with its ids. Bytes that are no UTF-8 count as
    U+FFFD. Only ``doc_id`` and the text are read, whatever other columns are called. A text of any length goes through in chunks; its
    ids are one array. Ranks must be below 2**20 and hold every single byte.
    """
    path = _default(path)
    known = dictionary(docs, path, most, text)
    name = f"{len(known[0])}:{int(known[0].sum()) if len(known[0]) else 0}:{int(known[2].sum()) if len(known[2]) else 0}"
    return text_rows(docs, text).select("doc_id", "body").mapInArrow(_encode(path, name, known), "doc_id long, n_tokens long, ids array<int>")


def _decode(path: str, ids: str) -> Callable:
    def run(batches):
        own = encoder(path)
        for b in batches:
            at = b.schema.names.index(ids)
            column = b.column(at)
            total = np.concatenate([[0], np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
            flat = column.flatten()
            if flat.null_count:
                raise ValueError("an id that is null")
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(total, total[i] + SENT, "right")) - 1)
                part = flat[total[i]:total[j]].to_numpy(zero_copy_only=False).astype(np.int64)
                bytes_of = np.concatenate([[0], np.cumsum(own.size[part])]) if not len(part) or part.max() < len(own.size) else None
                body = own.decode(part)
                n = np.diff(bytes_of[total[i:j + 1] - total[i]])
                others = [b.column(k).slice(i, j - i) for k in range(b.num_columns) if k != at]
                yield pa.RecordBatch.from_arrays([*others, binary_rows(body, n)], names=[*[x for x in b.schema.names if x != ids], "body"])
                i = j
    return run


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """The rows with ``body`` (the bytes of their tokens) instead of ``ids``; null ids give no bytes, an id that is no token is an error.

    Other columns stay, but for one called ``body``.
    """
    rest = [c for c in encoded.columns if c not in (ids, "body")]
    kept = encoded.select(*rest, ids)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != ids] + ["body binary"])
    return kept.mapInArrow(_decode(_default(path), ids), schema)
