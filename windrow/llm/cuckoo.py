"""A cuckoo filter over 128-bit keys, in numpy: whole arrays of keys are added, removed and looked up.

A key leaves a 16-bit fingerprint in one of two buckets of four slots; either bucket follows from
the other and the fingerprint. A key that is held is always found; one that is not is found with a
chance of about 8 / 65,535. Unlike a Bloom filter it forgets keys again. Only keys that are not
held may be added and only held ones removed, so an exact table must stand behind it.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4

#: Load after building, load at which a filter counts as full, rounds of moves before giving up.
ROOMY, FULL, MOVES = 0.7, 0.93, 500


class Cuckoo:
    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = np.uint64(len(slots) - 1)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> Cuckoo:
        """A filter of the given keys, with room for more."""
        buckets = 1
        while buckets * SLOTS * ROOMY < len(high):
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, SLOTS), np.uint16))
            if made.add(high, low):
                return made
            buckets *= 2

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    def held(self) -> int:
        return int(np.count_nonzero(self.slots))

    def has_room(self, more: int) -> bool:
        return self.held() + more <= FULL * self.slots.size

    def _places(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints (never 0) and first buckets; the two halves of a key are independent."""
        mark = low.view(np.uint64) % np.uint64(65_535) + np.uint64(1)
        return mark.astype(np.uint16), (high.view(np.uint64) >> np.uint64(20)) & self.mask

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) & self.mask)

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        mark, first = self._places(high, low)
        here = (self.slots[first] == mark[:, None]).any(axis=1)
        return here | (self.slots[self._other(first, mark)] == mark[:, None]).any(axis=1)

    def _put(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Fill free slots; which of the fingerprints found none."""
        order = np.argsort(bucket, kind="stable")
        turn = _turns(bucket[order])
        used = np.count_nonzero(self.slots[bucket[order]], axis=1)
        # Slots of a bucket are filled from the left.
        fits = used + turn < SLOTS
        taken = order[fits]
        self.slots[bucket[taken], (used + turn)[fits]] = mark[taken]
        left = np.ones(len(mark), bool)
        left[taken] = False
        return left

    def add(self, high: np.ndarray, low: np.ndarray) -> bool:
        """False when the filter is too full: then it must be built anew, with more buckets."""
        mark, bucket = self._places(high, low)
        left = self._put(mark, bucket)
        mark, bucket = mark[left], self._other(bucket[left], mark[left])
        for move in range(MOVES):
            left = self._put(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            # Each takes the place of another one, as far as the slots of its bucket go round.
            order = np.argsort(bucket, kind="stable")
            turn = _turns(bucket[order])
            moving = order[turn < SLOTS]
            slot = (turn[turn < SLOTS] + move) % SLOTS
            out = self.slots[bucket[moving], slot].copy()
            self.slots[bucket[moving], slot] = mark[moving]
            mark[moving] = out
            bucket[moving] = self._other(bucket[moving], out)
        return False

    def remove(self, high: np.ndarray, low: np.ndarray) -> None:
        mark, first = self._places(high, low)
        other = self._other(first, mark)
        # Keys that leave the same fingerprint in the same buckets go one at a time.
        same = np.lexsort((mark, np.minimum(first, other)))
        pairs = np.stack([np.minimum(first, other)[same], mark[same].astype(np.uint64)], axis=1)
        turn = np.empty(len(mark), np.int64)
        turn[same] = _turns(pairs)
        for now in range(int(turn.max(initial=-1)) + 1):
            m, a, b = mark[turn == now], first[turn == now], other[turn == now]
            there = (self.slots[a] == m[:, None]).any(axis=1)
            bucket = np.where(there, a, b)
            at = self.slots[bucket] == m[:, None]
            if not at.any(axis=1).all():
                raise ValueError("a key that the filter does not hold was removed")
            self.slots[bucket, at.argmax(axis=1)] = 0
            touched = np.unique(bucket)
            rows = self.slots[touched]
            self.slots[touched] = np.take_along_axis(rows, np.argsort(rows == 0, axis=1, kind="stable"), axis=1)


def _turns(ordered: np.ndarray) -> np.ndarray:
    """The number of each entry among equal neighbours, from 0."""
    if not len(ordered):
        return np.empty(0, np.int64)
    new = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(np.concatenate([[True], new.any(axis=1) if new.ndim > 1 else new]))
    return np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
