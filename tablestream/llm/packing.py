"""Cost-balanced packing of token ids into sequences.

Every document is tokenized once and ends with id 1. Stretches of a full sequence leave a long document where it is cut into pieces;
pieces meet in groups of bounded size (by a hash of document, position and a salt that differs between equal rows). Within a group the pieces are taken in descending
order of estimated attention cost (linear plus quadratic in length) and each goes to the lowest-cost sequence that has room for
it; when none has, it is cut and fills the lowest-cost sequences that are not full. A group opens as many sequences as its tokens need, so
less than one sequence a group is padding.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .merges import MARK, SHIFT, Merges
from .ragged import Remembered, starts_of, take_runs
from .shared import text_rows

CAPACITY = 2048
END_ID = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 1024        # cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n
GROUP_BYTES = 2 << 20                      # text bytes of a group of pieces
# words (by hash) and stems that a generation of a worker's memory holds, and bytes of the longest stem; text looked up together
KNOWN_WORDS, KNOWN_STEMS, LONGEST, BLOCK = 1_000_000, 250_000, 64, 4 << 20
MARKS = b".,;:!?#$%&*|\""
# letters that lower-case to one letter each whatever stands around them: A-Z and those of Latin-1
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("salt", pa.int64())])
PACKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("ids", pa.binary())])
_tokenizers: dict[str, tuple] = {}


class WordTokenizer:
    """Ids of whole texts from ids of their words: this tokenizer never joins across white space, so words can be remembered.

    Words go by a 64-bit hash; a block's different words are looked up together. A new word is put together from its stem (lower-cased,
    as the tokenizer does) and the marks after it, which are remembered too. Stems of plain letters get their ids by merge replay, many
    at once; all others from the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # tasks already use every core
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.words = Remembered(KNOWN_WORDS, np.uint16)
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        self.merges, self.inner, self.last = self._letters(path)

    @staticmethod
    def _letters(path: str) -> tuple[Merges | None, np.ndarray, np.ndarray]:
        """Merges, and the symbol of each byte inside a word and at its end (none if the file holds no merges in rank order)."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, none = model["vocab"], (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>":
            return none
        # byte-level vocabularies write a printable byte as itself and the n-th other one as the character 256 + n
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        spelt = dict(zip([*plain, *[b for b in range(256) if b not in plain]], [*map(chr, plain), *[chr(256 + i) for i in range(256 - len(plain))]]))
        pairs, before = {}, -1
        for m in model["merges"]:
            left, right = m.split(" ") if isinstance(m, str) else m
            new = ids.get(left + right)
            if new is None or new <= before or new >= MARK:
                return none
            before = new
            pairs[ids[left] << SHIFT | ids[right]] = new
        if any(c not in ids or c + "</w>" not in ids for c in spelt.values()):
            return none
        return Merges(pairs), np.array([ids[spelt[b]] for b in range(256)]), np.array([ids[spelt[b] + "</w>"] for b in range(256)])

    @staticmethod
    def parts(word: bytes) -> tuple[bytes, bytes, bool]:
        """Stem and trailing marks, where a cut between them changes no id, and whether the stem is plain letters."""
        stem = word.rstrip(MARKS)
        if LETTERS.fullmatch(stem):
            return stem.decode().lower().encode(), word[len(stem):], True
        if b"<" in word:                                       # may spell a special token
            return word, b"", False
        return (stem.lower(), word[len(stem):], False) if stem and stem[-1:].isalnum() else (word.lower(), b"", False)

    def _learn(self, plain: list[bytes], others: list[bytes]) -> None:
        """Ids of new stems, into the young generation."""
        if self.merges is None:
            plain, others = [], plain + others
        for w, e in zip(others, self.model.encode_batch_fast([x.decode("utf-8", "replace") for x in others], add_special_tokens=False)):
            self.young[w] = np.array(e.ids, "<u2").tobytes()
        if not plain:
            return
        size = np.array([len(w) for w in plain])
        data = np.frombuffer(b"".join(plain), np.uint8)
        symbols, end = self.inner[data], np.cumsum(size) - 1
        symbols[end] = self.last[data[end]]
        flat, n = self.merges.replay(symbols, size)
        raw, at = flat.astype("<u2").tobytes(), 0
        for w, z in zip(plain, (np.cumsum(n) * 2).tolist()):
            self.young[w] = raw[at:z]
            at = z

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each new word, and all ids."""
        cut = [self.parts(w) for w in words]
        young, old = self.young, self.old
        plain, others = set(), set()
        for stem, marks, letters in cut:
            for x, to in ((stem, plain if letters else others), (marks, others)):
                if x not in young:
                    if x in old:
                        young[x] = old[x]
                    else:
                        to.add(x)
        self._learn(list(plain), list(others - plain))
        ids = [young[stem] + young[marks] if marks else young[stem] for stem, marks, _ in cut]
        for w in [w for w in plain | others if len(w) > LONGEST]:
            del young[w]
        if len(young) > KNOWN_STEMS:
            self.old, self.young = young, {b"": b""}
        return np.array([len(x) // 2 for x in ids], np.int64), np.frombuffer(b"".join(ids), "<u2")

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, 16 bits an id."""
        data, hashes, start, end, counts = W.word_spans(texts)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        size, flat = self.words.rows(keys, lambda new: self._words([data[a:z] for a, z in zip(start[first[new]].tolist(), end[first[new]].tolist())]))
        each, begin = size[which], starts_of(size)[which]
        raw = b"".join(take_runs(flat, begin[i:i + (1 << 20)], each[i:i + (1 << 20)]).astype("<u2").tobytes() for i in range(0, len(each), 1 << 20))
        cut = (np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(counts)])] * 2).tolist()
        return [raw[a:z] for a, z in zip(cut, cut[1:])]


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _pieces(path: str, capacity: int):
    def run(batches):
        encode, end = tokenizer(path), np.array([END_ID], "<u2").tobytes()
        # equal rows get salts of their own: the partition and how many the same came before, whatever the order of a retry
        place, seen = TaskContext.get().partitionId() << 32, {}
        for rows in W.gather(batches, BLOCK):
            out = []
            for (doc, tid, _), ids in zip(rows, encode([r[2] for r in rows])):
                ids += end
                n = len(ids) // 2
                salt = seen[doc, tid] = seen.get((doc, tid), place - 1) + 1
                out += [(doc, a, n, ids[2 * a:2 * (a + capacity)], salt) for a in range(0, n, capacity)]
            for i in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i:i + 2000]), PIECE)], schema=PIECE)
    return run


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """For each piece its parts as (first token, number of tokens, sequence), by descending cost to the cheapest sequence with room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    free = np.full(-(-sum(lengths) // capacity), capacity, np.int64)
    cost = np.zeros(len(free))
    out: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    for i in order:
        at = 0
        while at < lengths[i]:
            n = lengths[i] - at
            fits = free >= n
            if not fits.any():
                fits = free > 0
            s = int(np.argmin(np.where(fits, cost, np.inf)))
            n = min(n, int(free[s]))
            out[i].append((at, n, s))
            free[s] -= n
            cost[s] += LINEAR * n + QUADRATIC * n * n
            at += n
    return out


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(c.to_pylist() for c in table.columns)), key=lambda r: (r[1] is None, r[1] or 0, r[2], r[4]))
        base = rows[0][0] << 32
        parts = assign([len(r[4]) // 2 for r in rows], capacity)
        used: dict[int, int] = {}
        out = []
        for (_, doc, start, total, ids), mine in zip(rows, parts):
            for a, n, s in mine:
                wide = np.frombuffer(ids, "<u2", n, 2 * a).astype("<u4").tobytes()
                out.append([doc, start + a, n, total, base + s, used.get(s, 0), 0, wide])
                used[s] = used.get(s, 0) + n
        for r in out:
            r[6] = used[r[4] - base]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PACKED)], schema=PACKED)
    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, doc_tokens, sequence_id, offset, sequence_tokens, ids``.

    ``ids`` are little-endian 32-bit ids; ``start`` counts the document's ids before the piece, ``offset`` the sequence's;
    ``sequence_tokens`` is what the sequence holds in all (the rest, unless it is a power of two, is padding). Null and empty
    texts are the end id alone. Rows without doc_id or with the same doc_id are packed each by itself. Only ``doc_id`` and ``text`` are read.
    The tokenizer must not merge across white space (a word tokenizer), with ids below 65,536.
    """
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    rows = text_rows(docs)
    total = rows.select(F.sum(F.octet_length("body") + 1)).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    cut = rows.mapInArrow(_pieces(tokenizer_path, capacity), "doc_id long, start long, doc_tokens long, ids binary, salt long")
    cut = cut.select(F.pmod(F.xxhash64("doc_id", "start", F.crc32("ids"), "salt"), F.lit(groups)).cast("long").alias("part"), "doc_id", "start", "doc_tokens", "ids")
    return cut.groupBy("part").applyInArrow(_pack(capacity), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, ids binary")
