"""A cuckoo filter over 64-bit hashes: set membership with deletion, in two bytes a key."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 500
LOAD = 0.8


class Full(Exception):
    """No room; build a larger filter from the exact keys."""


class CuckooFilter:
    """Keys may be deleted only if they are present. Never a false negative; about one in
    8,000 absent keys is reported present."""

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots

    @classmethod
    def build(cls, hashes: np.ndarray, room: float = 1.0) -> CuckooFilter:
        """A filter of distinct ``hashes`` with room for ``room`` times as many keys."""
        buckets = 1
        while buckets * SLOTS * LOAD < max(1.0, len(hashes) * room):
            buckets *= 2
        while True:
            made = cls(buckets)
            try:
                made.insert(hashes)
                return made
            except Full:
                buckets *= 2

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        slots = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(slots), slots)

    def dumps(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        marks = (hashes >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        first = (hashes & np.uint64(self.buckets - 1)).astype(np.int64)
        return marks, first, self._other(first, marks)

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        turned = (marks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ (turned & np.uint64(self.buckets - 1)).astype(np.int64)

    def _place(self, marks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put what fits into its bucket; the positions of what doesn't."""
        order = np.argsort(at, kind="stable")
        sorted_at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(sorted_at, sorted_at, "left")
        taken = (self.slots[sorted_at] != 0).sum(1)
        fits = taken + rank < SLOTS
        # Slots are filled from the left only while nothing was deleted; look for the free ones.
        free = np.argsort(self.slots[sorted_at[fits]] != 0, axis=1, kind="stable")
        column = free[np.arange(len(free)), rank[fits]]
        self.slots[sorted_at[fits], column] = marks[order[fits]]
        return order[~fits]

    def insert(self, hashes: np.ndarray) -> None:
        """Add distinct keys that are not present."""
        marks, first, second = self._places(hashes)
        left = self._place(marks, first)
        left = left[self._place(marks[left], second[left])] if len(left) else left
        for k in left.tolist():
            mark, at = int(marks[k]), int(second[k])
            for kick in range(MAX_KICKS):
                row = self.slots[at]
                if (free := np.flatnonzero(row == 0)).size:
                    row[free[0]] = mark
                    break
                turn = kick % SLOTS
                mark, row[turn] = int(row[turn]), mark
                at = int(self._other(np.array([at]), np.array([mark], np.uint16))[0])
            else:
                raise Full

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, bool)
        marks, first, second = self._places(hashes)
        wanted = marks[:, None]
        return (self.slots[first] == wanted).any(1) | (self.slots[second] == wanted).any(1)

    def delete(self, hashes: np.ndarray) -> None:
        """Remove keys that are present."""
        marks, first, second = self._places(hashes)
        for mark, a, b in zip(marks.tolist(), first.tolist(), second.tolist(), strict=True):
            for at in (a, b):
                if (found := np.flatnonzero(self.slots[at] == mark)).size:
                    self.slots[at, found[0]] = 0
                    break
