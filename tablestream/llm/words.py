"""Words, word hashes and rolling window hashes of many texts at once, in numpy.

A word is a run of bytes other than \\x20 and \\x09-\\x0D; in UTF-8 these are the same cuts as in code points, and
``bytes.split()`` cuts at exactly these bytes. Hashes are polynomials modulo 2**64 taken from prefix sums, mixed at the end,
so one pass serves every word (or window) of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        steps = [np.full(size, b, np.uint64) for b in (base, inverse)]
        for s in steps:
            s[0] = 1
        have = _powers[base] = tuple(np.multiply.accumulate(s) for s in steps)
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over the whole 64-bit word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(a: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every span ``a[start:end]`` of bytes."""
    power, back = _power_tables(_BYTE_BASE, len(a) + 1)
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    h = (total[end] - total[start]) * back[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def word_edges(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a block of bytes start and end."""
    edge = np.flatnonzero(np.diff((~_SPACE[a]).view(np.int8), prepend=0, append=0))
    return edge[::2], edge[1::2]


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte position of every word of one block."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start, end = word_edges(a)
    return span_hashes(a, start, end), start


def word_spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one piece, and hash, start and end of every word in it, with the number of words of each text."""
    data = b"\n".join(texts)
    hashes, starts, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(data):
        gap = _GAP.search(data, min(at + BLOCK, len(data)))
        to = gap.end() if gap else len(data)
        a = np.frombuffer(data, np.uint8, to - at, at)
        start, end = word_edges(a)
        hashes.append(span_hashes(a, start, end))
        starts.append(start + at)
        ends.append(end + at)
        at = to
    start = np.concatenate(starts)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    return data, np.concatenate(hashes), start, np.concatenate(ends), np.diff(np.searchsorted(start, first))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < BLOCK):
            size += len(texts[j]) + 1
            j += 1
        if j == i + 1 and len(texts[i]) > BLOCK:            # a long text goes through in blocks cut at white space
            at, text = 0, texts[i]
            while at < len(text):
                gap = _GAP.search(text, min(at + BLOCK, len(text)))
                end = gap.end() if gap else len(text)
                h, _ = _hash_block(text[at:end])
                hashes.append(h)
                counts[i] += len(h)
                at = end
        else:
            h, start = _hash_block(b"\n".join(texts[i:j]))
            hashes.append(h)
            first = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
            counts[i:j] = np.diff(np.searchsorted(start, first))
        i = j
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by position of its first word (runs over text borders included)."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    power, back = _power_tables(_WORD_BASE, len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power, out=total[1:])
    return mix((total[size:] - total[:-size]) * back[: len(words) - size + 1] + np.uint64(size))


def inside(counts: np.ndarray, size: int) -> np.ndarray:
    """Positions (in the words of all texts) where a window of ``size`` words stays within its text."""
    n = int(counts.sum())
    left = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    return np.flatnonzero(left >= size)


def gather(batches: Iterator[pa.RecordBatch], most: int, rows: int = 1 << 30) -> Iterator[list[tuple]]:
    """Rows of Arrow batches in groups of at most ``most`` bytes of the column ``body`` (one row at least)."""
    out: list[tuple] = []
    size = 0
    for b in batches:
        at = b.schema.names.index("body")
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if out and (size + len(row[at]) > most or len(out) >= rows):
                yield out
                out, size = [], 0
            out.append(row)
            size += len(row[at])
    if out:
        yield out


def runs(starts: np.ndarray, length: int, end: int) -> np.ndarray:
    """Union of [s, s + length) as sorted half-open pairs, cut at ``end``."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    s = np.unique(starts)
    new = np.flatnonzero(np.diff(s, prepend=s[0] - length - 1) > length)
    last = np.append(new[1:] - 1, len(s) - 1)
    return np.stack([s[new], np.minimum(s[last] + length, end)], axis=1)


def pack(values: Iterable[int] | np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()
