"""A cuckoo filter over 128-bit keys, all operations in bulk.

A key has a fingerprint of 16 bits and two buckets of four places; the second bucket follows from the first and the fingerprint, so stored fingerprints can move
between their two buckets without the key. A key that has been inserted is always found, one that hasn't seldom (about 8 in 65,535 at most), and an inserted key can
be taken out again. A full filter refuses an insertion and stays as it was before; the caller rebuilds a larger one from the keys.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.words import mixed

PLACES = 4
_MOVES = 500


class CuckooFilter:
    def __init__(self, buckets: int) -> None:
        """``buckets``: a power of two."""
        self.slots = np.zeros((buckets, PLACES), np.uint16)

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """Room for n keys at nine tenths of the places or less."""
        return cls(1 << max(0, (max(1, n) * 10 // (9 * PLACES))).bit_length())

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(1)
        out.slots = np.frombuffer(data, np.uint16).reshape(-1, PLACES).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def _prints(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket. keys: (n, 2) of 64 bits."""
        prints = (mixed(keys[:, 0]) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        return prints, (mixed(keys[:, 1]) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(prints.astype(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first = self._prints(keys)
        here = (self.slots[first] == prints[:, None]).any(axis=1)
        return here | (self.slots[self._other(first, prints)] == prints[:, None]).any(axis=1)

    def _place(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Puts as many as fit into free places of their buckets; which of them were placed."""
        order = np.argsort(bucket, kind="stable")
        own = bucket[order]
        start = np.flatnonzero(np.diff(own, prepend=-1))
        rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
        free = self.slots[own] == 0
        fits = rank < free.sum(axis=1)
        # the rank-th free place of the bucket
        place = (np.cumsum(free[fits], axis=1) == (rank[fits] + 1)[:, None]).argmax(axis=1)
        self.slots[own[fits], place] = prints[order[fits]]
        placed = np.zeros(len(bucket), bool)
        placed[order[fits]] = True
        return placed

    def insert(self, keys: np.ndarray) -> bool:
        """All keys, each different from all that are in; False, and nothing is changed, if they don't fit."""
        before = self.slots.copy()
        prints, bucket = self._prints(keys)
        placed = self._place(bucket, prints)
        bucket, prints = bucket[~placed], prints[~placed]
        for move in range(_MOVES):
            if not len(prints):
                return True
            bucket = self._other(bucket, prints)
            placed = self._place(bucket, prints)
            bucket, prints = bucket[~placed], prints[~placed]
            # one of each full bucket takes the place of a fingerprint, which goes on to its other bucket
            full, at = np.unique(bucket, return_index=True)
            place = (mixed(full.astype(np.uint64) + np.uint64(move << 40)) % np.uint64(PLACES)).astype(np.int64)
            prints[at], self.slots[full, place] = self.slots[full, place], prints[at]
        self.slots = before
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Keys that are in, each different."""
        prints, bucket = self._prints(keys)
        for _ in range(2):
            # one place for each key, so keys with the same fingerprint take different places
            order = np.lexsort((prints, bucket))
            own, mark = bucket[order], prints[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (mark[1:] != mark[:-1])
            start = np.flatnonzero(new)
            rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
            same = self.slots[own] == mark[:, None]
            gone = rank < same.sum(axis=1)
            place = (np.cumsum(same[gone], axis=1) == (rank[gone] + 1)[:, None]).argmax(axis=1)
            self.slots[own[gone], place] = 0
            left = np.ones(len(prints), bool)
            left[order[gone]] = False
            prints, bucket = prints[left], bucket[left]
            if not len(prints):
                return
            bucket = self._other(bucket, prints)
