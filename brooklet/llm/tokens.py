"""Encoding of many texts with a file of the tokenizers library, piece by piece.

A text is cut where the encoding cannot look across: around a single space or line feed between two characters
that are not white space, and between an ASCII letter or digit and a following ``.``, ``,`` or ``!``. Every
pre-tokenizer pattern used here starts a new match at these places and normalisation works within them (special
tokens hold no such place), so the ids of a text are the ids of its pieces in order. Pieces are told apart by a
64-bit hash and their size; the library encodes each distinct piece once and a bounded memo keeps the ids.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from brooklet.llm.textkit import raw_texts, span_hashes

MEMO_PIECES = 1_500_000

_ASCII_SOLID = np.zeros(256, dtype=bool)
_ASCII_SOLID[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,!"]] = True
# Lead bytes of characters that are never white space: two bytes from U+00C0 on, three bytes from U+4000 on.
_LEAD2 = np.zeros(256, dtype=bool)
_LEAD2[0xC3:0xE0] = True
_LEAD3 = np.zeros(256, dtype=bool)
_LEAD3[0xE4:0xF0] = True
_COMBINING_LEAD = np.zeros(256, dtype=bool)
_COMBINING_LEAD[[0xCC, 0xCD, 0xD2, 0xD6, 0xD7, 0xD8, 0xD9, 0xDB, 0xDC, 0xDD, 0xDE, 0xDF]] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Begins of all pieces, each text's begin included, and the end."""
    n = len(data)
    if n < 3:
        return np.unique(offsets)
    high = data >= 0x80
    before = _ASCII_SOLID[data]
    before[1:] |= high[1:] & _LEAD2[data[:-1]]
    before[2:] |= high[2:] & high[1:-1] & _LEAD3[data[:-2]]
    after = _ASCII_SOLID[data] | (_LEAD2[data] & ~_COMBINING_LEAD[data]) | _LEAD3[data]
    feed = data == 10
    lone = np.zeros(n, dtype=bool)
    lone[1:-1] = before[:-2] & (feed | (data == 32))[1:-1] & after[2:]
    lone[offsets[(offsets > 0) & (offsets < n)]] = False  # a text that begins or ends with the blank
    lone[offsets[offsets > 0] - 1] = False
    cut = lone.copy()
    cut[1:] |= (lone & feed)[:-1]
    cut[1:] |= _LETTER[data[:-1]] & _STOP[data[1:]]
    cut[offsets[offsets < n]] = True
    return np.append(np.flatnonzero(cut), n)


class _Memo:
    """Ids by piece hash: sorted hashes with the entry they stand for, in a large run and a small recent one."""

    def __init__(self, limit: int, dtype: type):
        self.limit, self.count, self.used = limit, 0, 0
        self.runs = [(np.zeros(0, np.uint64), np.zeros(0, np.int32)) for _ in range(2)]
        self.starts, self.lengths, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, dtype)

    def find(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The entry of each piece or -1; the size in bytes must agree as well."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        for keys, entries in self.runs:
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                found[hit] = entries[at[hit]]
        known = np.flatnonzero(found >= 0)
        found[known[self.sizes[found[known]] != sizes[known]]] = -1
        return found

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array), 1 << 16), array.dtype)])

    def lay_out(self, flat: np.ndarray) -> int:
        """Put ids behind the pool's entries, there until the next call, and tell where they begin."""
        self.pool = self._room(self.pool, self.used + len(flat))
        self.pool[self.used : self.used + len(flat)] = flat
        return self.used

    def add(self, hashes: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> None:
        """Make entries of pieces just laid out, as far as there is room."""
        keep = min(len(hashes), self.limit - self.count)
        if keep <= 0:
            return
        ends = np.cumsum(lengths[:keep])
        low, high, total = self.count, self.count + keep, self.used + int(ends[-1])
        self.starts, self.lengths, self.sizes = (self._room(x, high) for x in (self.starts, self.lengths, self.sizes))
        self.starts[low:high], self.lengths[low:high], self.sizes[low:high] = self.used + ends - lengths[:keep], lengths[:keep], sizes[:keep]
        self.count, self.used = high, total
        self.runs[1] = self._merged(self.runs[1], (hashes[:keep], np.arange(low, high, dtype=np.int32)))
        if len(self.runs[1][0]) > 1 << 16:
            self.runs = [self._merged(*self.runs), (np.zeros(0, np.uint64), np.zeros(0, np.int32))]

    @staticmethod
    def _merged(left: tuple, right: tuple) -> tuple:
        keys = np.concatenate([left[0], right[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([left[1], right[1]])[order]


class Encoder:
    """Encodes texts with a tokenizer file; keeps a bounded memo of pieces. One per Python worker and file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, memo: int = MEMO_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.memo = _Memo(memo, self.dtype)

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return cuts(data, offsets)

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter(chain.from_iterable(found), self.dtype, int(lengths.sum()))

    def encode(self, column: pa.Array, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) of every text's ids, and the ids (none if only the offsets are asked for)."""
        data, offsets = raw_texts(column)
        if not len(data):
            return np.zeros(len(offsets), np.int64), np.zeros(0, self.dtype)
        bounds = self._cuts(data, offsets)
        hashes, first, codes = np.unique(span_hashes(data, bounds[:-1], bounds[1:]), return_index=True, return_inverse=True)
        bytes_of = bounds[first + 1] - bounds[first]
        entry = self.memo.find(hashes, bytes_of)
        starts, lengths = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        known, missing = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        starts[known], lengths[known] = self.memo.starts[entry[known]], self.memo.lengths[entry[known]]
        if len(missing):
            raw = data.tobytes()
            new_lengths, flat = self._ids([raw[bounds[i] : bounds[i + 1]].decode() for i in first[missing].tolist()])
            starts[missing], lengths[missing] = self.memo.lay_out(flat) + np.cumsum(new_lengths) - new_lengths, new_lengths
            self.memo.add(hashes[missing], bytes_of[missing], new_lengths)
        sizes = lengths[codes]
        ends = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=ends[1:])
        text_ends = ends[np.searchsorted(bounds, offsets)]
        if not ids:
            return text_ends, np.zeros(0, self.dtype)
        at = np.repeat(starts[codes] - ends[:-1], sizes)
        at += np.arange(len(at))
        return text_ends, self.memo.pool[at]
