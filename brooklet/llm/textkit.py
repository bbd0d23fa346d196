"""Byte-level kernels shared by the operators: texts of an Arrow batch as one array, words, hashes.

A batch is never joined into Python strings. Words are slices of the UTF-8 bytes, their 64-bit hashes come
from prefix sums of a polynomial, and hashes of k consecutive words from prefix sums over the word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Word characters after lower-casing A-Z: everything but blanks; or digits, a-z and all beyond ASCII.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SLICE_BYTES = 500_000
_BASE, _GRAM_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BYTE_CODE = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64)


def with_fields(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` and further fields, as DDL."""
    return ", ".join([*(f"`{name}` {kind}" for name, kind in df.dtypes), *more])


def small_enough(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df``, a written table of a few numbers a row, to be broadcast if it has at most ``rows`` rows; else it
    is joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the n + 1 offsets. Null counts as empty."""
    array = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece take about ``limit`` bytes; one text is never cut."""
    if not batch.num_rows:
        return
    _, offsets = raw_texts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        have = (both[0], both[1])
        if size <= 4 * SLICE_BYTES:
            _POWERS[base] = have
    return have


def _spans(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    return _spans(_BYTE_CODE[data], _BASE, starts, ends)


@dataclass
class Words:
    """Words of some texts: byte spans, hashes, and where each text's words begin (n + 1 offsets)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which k words of one text follow each other, and the hashes of those k words."""
        left = np.repeat(self.offsets[1:], self.counts) - np.arange(len(self.starts))
        at = np.flatnonzero(left >= k)
        return at, _spans(self.hashes, _GRAM_BASE, at, at + k)

    def joined(self, first: int, last: int) -> bytes:
        """Words first..last-1, separated by one space."""
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(first, last))


def words(column: pa.Array, is_word: np.ndarray) -> Words:
    """The words of every text, with A-Z in lower case."""
    raw, offsets = raw_texts(column)
    data = LOWER[raw]
    inside = is_word[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = span_hashes(data, starts, ends)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """A list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
