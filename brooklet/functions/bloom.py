"""A Bloom filter in pages, to be kept in state: its size is fixed by the number of items and the error rate."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

PAGE_BITS = 1 << 15


@dataclass(frozen=True)
class Bloom:
    """For ``items`` distinct items a new one is taken for a known one with probability ``error`` at most (on average
    over the filling, much less). Every item has its bits in one page, so a look costs one page of 4 KB."""

    items: int
    error: float

    @property
    def pages(self) -> int:
        # A quarter more than an even filling needs: pages fill unevenly.
        bits = -self.items * math.log(self.error) / math.log(2) ** 2
        return max(1, math.ceil(1.25 * bits / PAGE_BITS))

    @property
    def probes(self) -> int:
        return max(1, round(-math.log2(self.error)))

    def place(self, item: str) -> tuple[int, list[int]]:
        """The page of an item and its bits there."""
        digest = hashlib.blake2b(item.encode(), digest_size=16).digest()
        page, step = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
        first, stride = step % PAGE_BITS, (step >> 32) | 1
        return page % self.pages, [(first + i * stride) % PAGE_BITS for i in range(self.probes)]

    @staticmethod
    def empty() -> bytearray:
        return bytearray(PAGE_BITS // 8)

    @staticmethod
    def add(page: bytearray, bits: list[int]) -> bool:
        """Set the bits; True if one was missing, so the item is new."""
        new = False
        for bit in bits:
            if not page[bit >> 3] >> (bit & 7) & 1:
                page[bit >> 3] |= 1 << (bit & 7)
                new = True
        return new

    @staticmethod
    def merge(left: bytes, right: bytes) -> bytes:
        """The page of a filter that has seen the items of both."""
        return (int.from_bytes(left, "little") | int.from_bytes(right, "little")).to_bytes(len(left), "little")
