"""A cuckoo filter over 32-byte digests, with the digests themselves kept per bucket.

The filter answers most lookups of new digests from 16-bit fingerprints alone. A hit is verified
against the digests stored for the two buckets, so answers are exact. What belongs to a digest is
stored in its slot. Deleting frees the slot; an insertion that finds no room within ``KICKS``
moves doubles the table and rebuilds it from the stored digests. One filter serves one shard of
the digest space.
"""

from __future__ import annotations

import random
from array import array

SLOTS = 4
KICKS = 200


class CuckooIndex:
    """Live digests of a shard, each with a value: ``insert``, ``get``, ``delete``, ``in``."""

    def __init__(self, buckets: int = 4):
        self._start(max(2, 1 << (buckets - 1).bit_length()))
        self.resizes = 0
        self.false_hits = 0

    def _start(self, buckets: int) -> None:
        self.buckets = buckets
        self.marks = array("H", bytes(2 * buckets * SLOTS))  # 0: a free slot
        self.stored: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list = [None] * (buckets * SLOTS)
        self._random = random.Random(buckets)
        self.size = 0

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint and both buckets; the second follows from the first and the fingerprint."""
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[16:24], "little") & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        return self._find(digest) >= 0

    def _find(self, digest: bytes) -> int:
        mark, first, second = self._place(digest)
        marks, stored = self.marks, self.stored
        for bucket in (first, second) if first != second else (first,):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if marks[slot] == mark:  # a hit of the filter: verify the content
                    if stored[slot] == digest:
                        return slot
                    self.false_hits += 1
        return -1

    def get(self, digest: bytes):
        """The value of a live digest; None for any other."""
        slot = self._find(digest)
        return None if slot < 0 else self.values[slot]

    def insert(self, digest: bytes, value=None) -> bool:
        """True if the digest is new; a live one stays as it is, with its value."""
        if self._find(digest) >= 0:
            return False
        while True:
            homeless = self._put(digest, value)
            if homeless is None:
                return True
            digest, value = homeless
            self._resize()

    def _free(self, bucket: int, mark: int, digest: bytes, value) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.marks[slot]:
                self.marks[slot], self.stored[slot], self.values[slot] = mark, digest, value
                self.size += 1
                return True
        return False

    def _put(self, digest: bytes, value) -> tuple | None:
        """Store a digest; the one left without a slot, with its value, if the table overflows."""
        mark, bucket, second = self._place(digest)
        if self._free(bucket, mark, digest, value) or self._free(second, mark, digest, value):
            return None
        bucket = self._random.choice((bucket, second))
        for _ in range(KICKS):
            slot = bucket * SLOTS + self._random.randrange(SLOTS)
            moved = self.marks[slot], self.stored[slot], self.values[slot]
            self.marks[slot], self.stored[slot], self.values[slot] = mark, digest, value
            mark, digest, value = moved
            bucket = self._other(bucket, mark)
            if self._free(bucket, mark, digest, value):
                return None
        return digest, value

    def _resize(self) -> None:
        """Double the table and insert the stored digests anew."""
        live = list(self.items())
        buckets = self.buckets
        while True:
            buckets *= 2
            self.resizes += 1
            self._start(buckets)
            if all(self._put(*entry) is None for entry in live):
                return

    def delete(self, digest: bytes) -> bool:
        """Free the digest's slot; False if it is not live."""
        slot = self._find(digest)
        if slot < 0:
            return False
        self.marks[slot], self.stored[slot], self.values[slot] = 0, None, None
        self.size -= 1
        return True

    def __iter__(self):
        return (d for d in self.stored if d is not None)

    def items(self):
        """Live digests with their values."""
        return ((d, v) for d, v in zip(self.stored, self.values) if d is not None)

    def __len__(self) -> int:
        return self.size
