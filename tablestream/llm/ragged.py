"""Rows of different lengths in flat arrays, and what a task remembers of them by 64-bit keys."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


def take_runs(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``flat[s:s + n]`` of every pair of ``start`` and ``size``, one after the other."""
    end = np.cumsum(size)
    if not len(end) or not end[-1]:
        return flat[:0]
    return flat[np.repeat(start - (end - size), size) + np.arange(end[-1])]


def starts_of(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def binary_rows(flat: np.ndarray, size: np.ndarray) -> pa.Array:
    """Rows of bytes as an Arrow array."""
    offset = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset), pa.py_buffer(np.ascontiguousarray(flat))])


def list_rows(flat: np.ndarray, size: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers as an Arrow array of lists."""
    offset = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offset), pa.array(flat.astype(np.int32)))


class Remembered:
    """Rows of ids by 64-bit key, in two generations of at most ``most`` keys (and the keys of one block more).

    When a generation is full it becomes the old one; rows that are asked for again move to the young one, the others are forgotten
    when the next generation is full. Forgetting costs time only: a forgotten row is computed anew.
    """

    def __init__(self, most: int, kind: type):
        self.most, self.kind = most, kind
        self.young, self.old = self._empty(), self._empty()

    def _empty(self) -> tuple[np.ndarray, ...]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, self.kind)

    @staticmethod
    def _at(part: tuple[np.ndarray, ...], keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not."""
        if not len(part[0]):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(part[0], keys), len(part[0]) - 1)
        return np.where(part[0][at] == keys, at, -1)

    def add(self, keys: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Remember new rows; ``keys`` are sorted and not among the young ones."""
        have, start, sizes, pool = self.young
        at = np.searchsorted(have, keys)
        self.young = (np.insert(have, at, keys), np.insert(start, at, starts_of(size) + len(pool)), np.insert(sizes, at, size),
                      np.concatenate([pool, flat.astype(self.kind)]))

    def rows(self, keys: np.ndarray, compute: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and values of the rows of sorted, distinct ``keys``; ``compute`` gives them for the places of unknown keys."""
        at = self._at(self.young, keys)
        absent = np.flatnonzero(at < 0)
        if len(absent):
            before = self._at(self.old, keys[absent])
            again = before >= 0
            if again.any():
                at = before[again]
                self.add(keys[absent[again]], self.old[2][at], take_runs(self.old[3], self.old[1][at], self.old[2][at]))
            new = absent[~again]
            if len(new):
                self.add(keys[new], *compute(new))
            at = self._at(self.young, keys)
        size = self.young[2][at].astype(np.int64)
        flat = take_runs(self.young[3], self.young[1][at], size)
        if len(self.young[0]) > self.most:
            self.old, self.young = self.young, self._empty()
        return size, flat
