"""Merge replay: byte-pair merges of many words at once, in rank order, from an inverted index.

The symbols of all words stand in one line, a mark between words. An index says for each merge at which places of the line its pair
stands. Merges are taken in rank order; each is applied at all its places, and only the pairs with the two neighbours of a place are
looked up again and entered under their own merges. A merge whose pair is nowhere costs nothing.
"""

from __future__ import annotations

import heapq

import numpy as np

SHIFT = 20
MARK = (1 << SHIFT) - 1             # between words; no symbol has this id
PLACES = 1_000_000                    # symbols replayed in one line


class Merges:
    """``pairs`` gives the id of the merged symbol by ``left << SHIFT | right``; ids rise with the rank of the merge."""

    def __init__(self, pairs: dict[int, int]):
        self.pairs = pairs
        key = np.fromiter(pairs, np.int64, len(pairs))
        value = np.fromiter(pairs.values(), np.int64, len(pairs))
        left, right = key >> SHIFT, key & MARK
        order = np.lexsort((right, left))
        self.by_left = self._rows(left[order], right[order], value[order])
        order = np.lexsort((left, right))
        self.by_right = self._rows(right[order], left[order], value[order])
        # symbols that come after a merge they take part in (tables of merges not learned in order, or of every way to cut a token)
        self.early = set(left[value < left].tolist()) | set(right[value < right].tolist())
        self.narrow = len(value) == 0 or int(value.max()) < 1 << 16          # 16-bit keys are sorted by digits

    @staticmethod
    def _rows(group: np.ndarray, other: np.ndarray, value: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """For each symbol the sorted symbols it merges with, and into what."""
        first = np.flatnonzero(np.diff(group, prepend=-1))
        last = np.append(first[1:], len(group))
        return {g: (other[a:z], value[a:z]) for g, a, z in zip(group[first].tolist(), first.tolist(), last.tolist())}

    @staticmethod
    def _merged(row: tuple[np.ndarray, np.ndarray] | None, other: np.ndarray) -> np.ndarray:
        """What a symbol and each of ``other`` merge into, -1 for nothing."""
        if row is None:
            return np.full(len(other), -1)
        at = np.minimum(np.searchsorted(row[0], other), len(row[0]) - 1)
        return np.where(row[0][at] == other, row[1][at], -1)

    def one_by_one(self, symbols: list[int]) -> list[int]:
        """The same for one word, the plain way: merge the leftmost pair of the lowest rank until there is none."""
        word = list(symbols)
        while len(word) > 1:
            ids = [self.pairs.get(a << SHIFT | b, MARK) for a, b in zip(word, word[1:])]
            least = min(ids)
            if least == MARK:
                break
            at = ids.index(least)
            word[at:at + 2] = [least]
        return word

    def replay(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as symbols (``size`` of them each, one at least), and how many each word has."""
        out, sizes = [], []
        ends = np.cumsum(size)
        i = 0
        while i < len(size):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + PLACES, "right")))
            flat, n = self._line(symbols[done:ends[j - 1]], size[i:j])
            out.append(flat)
            sizes.append(n)
            i = j
        return (np.concatenate(out), np.concatenate(sizes)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _first_merges(self, tok: np.ndarray) -> np.ndarray:
        """Merge of each pair of neighbours, -1 for none. Few symbols are there before the first merge: a table of all pairs is small."""
        there = np.flatnonzero(np.bincount(tok[tok != MARK]))
        table = np.full((len(there) + 1, len(there) + 1), -1, np.int32)
        for i, left in enumerate(there.tolist()):
            table[i, :-1] = self._merged(self.by_left.get(left), there)
        place = np.zeros(int(there[-1]) + 1, np.int32)
        place[there] = np.arange(len(there))
        place = np.where(tok == MARK, len(there), place[np.where(tok == MARK, 0, tok)])
        return table[place[:-1], place[1:]]

    def _line(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.cumsum(size + 1) - size                   # of each word; the line starts with a mark and has one after each word
        tok = np.full(len(symbols) + len(size) + 1, MARK, np.int32)
        tok[np.arange(len(symbols)) + np.repeat(np.arange(1, len(size) + 1), size)] = symbols
        now = np.append(self._first_merges(tok), np.int32(-1))       # merge of the pair that starts here
        index: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def enter(places: np.ndarray, merge: np.ndarray) -> None:
            there = merge >= 0
            places, merge = places[there], merge[there]
            by = np.argsort(merge.astype(np.uint16) if self.narrow else merge, kind="stable")
            places, merge = places[by], merge[by]
            cut = np.flatnonzero(np.diff(merge, prepend=-1))
            for x, a, z in zip(merge[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(merge)]):
                if x not in index:
                    index[x] = []
                    heapq.heappush(order, x)
                index[x].append(places[a:z])

        enter(np.arange(len(tok), dtype=np.int32), now)
        after, before = np.arange(1, len(tok) + 1, dtype=np.int32), np.arange(-1, len(tok) - 1, dtype=np.int32)
        odd: list[np.ndarray] = []
        while order:
            merge = heapq.heappop(order)
            parts = index.pop(merge)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[now[at] == merge]                        # others are gone with an earlier merge
            if not len(at):
                continue
            right = after[at]
            if len(at) > 1 and (right[:-1] == at[1:]).any():          # equal symbols in a row: every second place of such a run
                keep, last = [], -1
                for i, (a, b) in enumerate(zip(at.tolist(), right.tolist())):
                    if a != last:
                        keep.append(i)
                        last = b
                at, right = at[keep], right[keep]
            follow = after[right]
            if merge in self.early:                          # with the neighbours as they are before any of them is merged
                early = np.zeros(len(at), bool)
                for x in (self._merged(self.by_left.get(merge), tok[follow]), self._merged(self.by_right.get(merge), tok[before[at]])):
                    early |= (x >= 0) & (x < merge)
                odd.append(at[early])
            after[at], before[follow], tok[at], tok[right], now[right] = follow, at, merge, -1, -1
            new = self._merged(self.by_left.get(merge), tok[follow])
            old = self._merged(self.by_right.get(merge), tok[before[at]])
            now[at], now[before[at]] = new, old
            if merge in self.early:
                odd.append(at[(new >= 0) & (new < merge) | (old >= 0) & (old < merge)])
            if (new >= 0).any() or (old >= 0).any():
                enter(np.concatenate([at, before[at]]), np.concatenate([new, old]))
        alive = (tok >= 0) & (tok != MARK)
        total = np.concatenate([[0], np.cumsum(alive)])
        flat, sizes = tok[alive], total[first + size] - total[first]
        # an earlier merge that only a later one makes possible (tables of merges not learned in order): these words go by themselves
        again = np.unique(np.searchsorted(first, np.concatenate(odd), "right") - 1) if odd else []
        for w in reversed(list(again)):
            start = int(sizes[:w].sum())
            own = self.one_by_one(symbols[int(size[:w].sum()):int(size[:w + 1].sum())].tolist())
            flat = np.concatenate([flat[:start], own, flat[start + sizes[w]:]])
            sizes[w] = len(own)
        return flat, sizes
