"""A cuckoo filter over 128-bit keys, filled and asked by whole arrays."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lives in one of two buckets.

    It never misses a key that is in it, and takes keys out again; keys that
    share fingerprint and buckets are stored once each and stand for each other.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """Room for twice the keys at hand, at most 40 % full to begin with."""
        return cls(1 << max(2, int(np.ceil(np.log2(max(n, 1) * 2.5 / SLOTS + 1)))))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _marks(self, hi: np.ndarray) -> np.ndarray:
        return (hi.astype(np.uint64) % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)

    def _first(self, lo: np.ndarray) -> np.ndarray:
        return (lo.astype(np.uint64) & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket, mark):
        step = (np.asarray(mark).astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7)
        return np.asarray(bucket).astype(np.int64) ^ (step & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        marks, first = self._marks(hi), self._first(lo)
        second = self._other(first, marks)
        near = (self.table[first] == marks[:, None]).any(1)
        return near | (self.table[second] == marks[:, None]).any(1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if some key found no place; the filter must then be built anew, with more buckets."""
        marks, first = self._marks(hi), self._first(lo)
        for of in (lambda: first, lambda: self._other(first, marks)):
            places, left = of(), np.arange(len(marks))
            for slot in range(SLOTS):
                free = left[self.table[places[left], slot] == 0]
                chosen = free[np.unique(places[free], return_index=True)[1]]
                self.table[places[chosen], slot] = marks[chosen]
                left = np.setdiff1d(left, chosen, assume_unique=True)
            marks, first = marks[left], first[left]
        return all(self._kick(int(b), int(m)) for b, m in zip(first, marks))

    def _kick(self, bucket: int, mark: int) -> bool:
        for turn in range(MAX_KICKS):
            bucket = int(self._other(bucket, mark))
            row = self.table[bucket]
            if (row == 0).any():
                row[int(np.argmax(row == 0))] = mark
                return True
            slot = (turn * 7 + mark) % SLOTS
            mark, row[slot] = int(row[slot]), mark
        return False

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out keys that are in the filter."""
        marks, first = self._marks(hi), self._first(lo)
        second = self._other(first, marks)
        for mark, places in zip(marks, zip(first, second)):
            for bucket in places:
                hit = np.flatnonzero(self.table[bucket] == mark)
                if len(hit):
                    self.table[bucket, hit[0]] = 0
                    break
            else:
                raise KeyError("a key that is not in the filter was to be deleted")
