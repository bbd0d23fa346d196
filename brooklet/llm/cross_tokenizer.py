"""Alignment of the tokens that two tokenizers make of the same texts, and corpus-wide counts of linked ids.

Both encodings of ``space + text`` are laid out over its UTF-8 bytes. Per batch, ``pandas.merge_asof`` keyed by
document gives the token of the other side that covers each token's first byte; the union of both directions is
all overlapping pairs, and pairs with equal ends cut both sides into *groups*. Every A token of a group is
*linked* with every B token of it.

The count of an id pair is the number of documents that hold it linked. Documents are dealt to blocks of about
``BLOCK_BYTES`` of text. A block asks for the counts of its distinct pairs, not for those of its documents: few rows
move, and a pair that is in every document is one row a block.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brooklet.llm.textkit import byte_slices, raw_texts, with_fields
from brooklet.llm.tokens import Encoder
from brooklet.session import saved

BLOCK_BYTES = 8_000_000
LINKS_AT_ONCE = 2_000_000


class _Bytes:
    """The bytes of every id of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        lengths = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        at += np.arange(len(at))
        return self.data[at]


class ByteSide(Encoder):
    """A byte-level BPE file of the tokenizers library; special strings in texts are plain text."""

    _made: dict[str, ByteSide] = {}

    def __init__(self, path: str):
        super().__init__(path)
        self.library.encode_special_tokens = True
        vocabulary = self.library.get_vocab()
        # Byte-level entries write a byte as itself if it is printable Latin-1, else as the next letter from U+0100 on.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            entries[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes = _Bytes(entries)


class PieceSide(Encoder):
    """A sentencepiece model that puts a space before every text.

    Unless a piece holds a space behind another character, no piece crosses the begin of a run of spaces: texts are
    cut there and every distinct part is encoded once. Otherwise whole texts are encoded.
    """

    _made: dict[str, PieceSide] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        from brooklet.llm.tokens import MEMO_PIECES, _Memo

        self.library = SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.dtype = np.uint16 if len(pieces) <= 1 << 16 else np.uint32
        self.memo = _Memo(MEMO_PIECES, self.dtype)
        self.bytes = _Bytes([bytes([int(p[1:-1], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.space = self.library.piece_to_id("▁")
        whole = "".join(self.library.id_to_piece(i) for i in self.library.encode(" a  b "))
        self.cut = whole == "▁▁a▁▁b▁" and not any("▁" in p.lstrip("▁") for p in pieces)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.cut:
            return np.unique(offsets)
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[offsets < len(data)]] = True
        return np.append(np.flatnonzero(begins), len(data))

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode([p[1:] for p in pieces], num_threads=1)  # the model adds the space itself
        if self.cut:  # a last blank is a part of its own, for which the model would add nothing
            found = [ids or [self.space] for ids in found]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter((i for ids in found for i in ids), self.dtype, int(lengths.sum()))


@dataclass
class _Side:
    """Tokens of some texts: ids, byte ranges over all texts, where each text's tokens begin, group of each token."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    group: np.ndarray | None = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def _side(encoder: ByteSide | PieceSide, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, their offsets by text, and how many bytes each text's tokens have."""
    offsets, ids = encoder.encode(column)
    ends = np.concatenate([[0], np.cumsum(encoder.bytes.lengths[ids])])
    return ids, offsets, np.diff(ends[offsets])


def _kept(ids: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the tokens of the texts to keep; the others have none."""
    counts = np.where(keep, np.diff(offsets), 0)
    return ids[np.repeat(keep, np.diff(offsets))], np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Aligned:
    """Both sides of some texts and their groups; texts without tokens have none."""

    a: _Side
    b: _Side
    group_offsets: np.ndarray  # of each text, n + 1
    overlaps: pd.DataFrame  # a, b: indices of overlapping tokens

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        n = int(self.group_offsets[-1])
        return np.bincount(self.a.group, minlength=n), np.bincount(self.b.group, minlength=n)

    def links(self, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked ids by text: text, A id, B id, how often. ``base`` is above every id."""
        in_a, in_b = self.sizes
        first_b = np.cumsum(in_b) - in_b
        partners = in_b[self.a.group]
        total = np.cumsum(partners)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at, doc = 0, self.a.doc
        while at < len(partners):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + LINKS_AT_ONCE, "right")))
            n = partners[at:end]
            a = np.repeat(np.arange(at, end), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + first_b[self.a.group[a]]
            found.append(np.unique((doc[a] * base + self.a.ids[a]) * base + self.b.ids[b], return_counts=True))
            at = end
        if not found:
            return (np.zeros(0, np.int64),) * 4
        keys, times = found[0]
        if len(found) > 1:
            keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            times = np.bincount(where, weights=np.concatenate([t for _, t in found])).astype(np.int64)
        return keys // (base * base), keys // base % base, keys % base, times

    def written(self) -> list[bytes]:
        """Of each text ``a1,a2|b1;a3|b2,b3``: the ids of its groups in order."""
        in_a, in_b = self.sizes
        n = len(self.a.ids) + len(self.b.ids)
        ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        place_a = np.arange(len(self.a.ids)) + (np.cumsum(in_b) - in_b)[self.a.group]
        place_b = np.arange(len(self.b.ids)) + np.cumsum(in_a)[self.b.group]
        ids[place_a], ids[place_b] = self.a.ids, self.b.ids
        mark[np.cumsum(in_a) + np.cumsum(in_b) - in_b - 1] = ord("|")
        mark[np.cumsum(in_a + in_b) - 1] = ord(";")
        digits = np.ones(n, np.int64)
        for power in range(1, 10):
            digits += ids >= 10**power
        ends = np.cumsum(digits + 1)
        out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
        out[ends - 1] = mark
        left = ids
        for place in range(int(digits.max()) if n else 0):
            there = np.flatnonzero(digits > place)
            out[ends[there] - 2 - place] = 48 + left[there] % 10
            left = left // 10
        bounds = np.concatenate([[0], ends])[self.a.offsets + self.b.offsets]
        raw = out.tobytes()
        return [raw[s : max(s, e - 1)] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def align_texts(column: pa.Array, a_side: ByteSide, b_side: PieceSide) -> Aligned:
    """The tokens of ``space + text`` on both sides, as groups. Null and empty texts, and texts that the tokens of a
    side do not spell exactly, have no tokens."""
    texts = column.cast(pa.large_string()).fill_null("")
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    data, offsets = raw_texts(spaced)
    sizes = np.diff(offsets)
    sides = [_side(encoder, spaced) for encoder in (a_side, b_side)]
    keep = (sizes > 1) & (sides[0][2] == sizes) & (sides[1][2] == sizes)
    for _ in range(2):  # of the right lengths, then of the right bytes
        ids, token_offsets = zip(*(_kept(x[0], x[1], keep) for x in sides))
        chosen = data[np.repeat(keep, sizes)]
        owner = np.repeat(np.flatnonzero(keep), sizes[keep])
        differs = (a_side.bytes.of(ids[0]) != chosen) | (b_side.bytes.of(ids[1]) != chosen)
        if not differs.any():
            break
        keep = keep.copy()
        keep[owner[differs]] = False
    both = []
    for encoder, own, own_offsets in zip((a_side, b_side), ids, token_offsets):
        lengths = encoder.bytes.lengths[own]
        ends = np.cumsum(lengths)
        both.append(_Side(own.astype(np.int64), ends - lengths, ends, own_offsets))
    a, b = both
    frames = [pd.DataFrame({"doc": s.doc, "at": s.starts, name: np.arange(len(s.ids))}) for s, name in ((a, "a"), (b, "b"))]
    covered = [pd.merge_asof(x, y, on="at", by="doc", direction="backward")[["a", "b"]] for x, y in (frames, frames[::-1])]
    # Both directions find a pair only if its tokens begin together.
    again = a.starts[covered[1]["a"].to_numpy()] == b.starts[covered[1]["b"].to_numpy()]
    overlaps = pd.concat([covered[0], covered[1][~again]], ignore_index=True)
    equal = overlaps[a.ends[overlaps["a"].to_numpy()] == b.ends[overlaps["b"].to_numpy()]]
    last_a, last_b = np.sort(equal["a"].to_numpy()), np.sort(equal["b"].to_numpy())
    a.group, b.group = np.searchsorted(last_a, np.arange(len(a.ids))), np.searchsorted(last_b, np.arange(len(b.ids)))
    return Aligned(a, b, np.searchsorted(last_a, a.offsets), overlaps)


def align(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id, groups``, the groups in order as structs of ``a`` and ``b`` ids.

    ``a_path`` is a byte-level file of the tokenizers library, ``b_path`` a sentencepiece model; every executor
    can open both. Null and empty texts, and texts that a side does not spell, have no groups. Repeated rows are
    aligned alike; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = with_fields(rows.select("id"), "groups array<struct<a:array<int>,b:array<int>>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = ByteSide.of(a_path), PieceSide.of(b_path)
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                found = align_texts(batch.column("text"), *sides)
                lists = []
                for side, counts in zip((found.a, found.b), found.sizes):
                    ends = np.concatenate([[0], np.cumsum(counts)])
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(side.ids, pa.int32())))
                groups = pa.StructArray.from_arrays(lists, ["a", "b"])
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(found.group_offsets, pa.int32()), groups)], ["id", "groups"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)


_STATS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _packed(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    raw = values.astype("<u4").tobytes()
    return [raw[4 * s : 4 * e] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def count_links(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Texts are aligned as by ``align``; ``groups_sha256`` is the hex digest of the groups as ``a1,a2|b1;a3|b2,b3``,
    empty without tokens. The count of an id pair is the number of rows that hold it linked: ``count_sum`` is its
    sum over all links, ``n_best`` the number of links whose count is the highest of their A id. Repeated rows
    count one by one; texts without tokens have zeros; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    fields = with_fields(rows.select("id"), _STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        a_side, b_side = ByteSide.of(a_path), PieceSide.of(b_path)
        base = max(len(a_side.bytes.lengths), len(b_side.bytes.lengths))
        block, taken = TaskContext.get().partitionId() << 32, 0
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                found = align_texts(batch.column("text"), a_side, b_side)
                doc, a, b, times = found.links(base)
                n = batch.num_rows
                bounds = np.searchsorted(doc, np.arange(n + 1))
                in_a, in_b = found.sizes
                links = np.concatenate([[0], np.cumsum(in_a * in_b)])[found.group_offsets]
                digests = [hashlib.sha256(w).hexdigest() if w else "" for w in found.written()]
                counts = [np.diff(x) for x in (found.a.offsets, found.b.offsets, found.group_offsets, links)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), batch.column("id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), *(pa.array(_packed(x, bounds), pa.binary()) for x in (a, b, times))],
                    ["block", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"],
                )
                taken += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
                if taken >= block_bytes:
                    block, taken = block + 1, 0

    aligned = saved(rows.mapInArrow(run, f"block bigint, {fields}, a binary, b binary, times binary"), "tokens-aligned")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(raw_bytes(batch.column(c)), "<u4").astype(np.int64) for c in ("a", "b"))
            held = pc.binary_length(batch.column("a")).to_numpy() // 4
            owner = np.repeat(batch.column("block").to_numpy(), held)
            for block in np.unique(owner):
                mine = owner == block
                keys, n = np.unique(a[mine] << 32 | b[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(keys), pa.int64()), pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF, pa.int32()), pa.array(n, pa.int64())], ["block", "a", "b", "n"]
                )

    asked = saved(aligned.select("block", "a", "b").mapInArrow(distinct, "block bigint, a int, b int, n bigint"), "tokens-asked")
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("n"))
    # One A id has at most as many partners as the B vocabulary has ids.
    counts = saved(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a"))), "tokens-counts")
    answers = asked.select("block", "a", "b").distinct().join(counts, ["a", "b"])

    def score(mine: pa.Table, known: pa.Table) -> pa.Table:
        known = known.combine_chunks()
        keys = known.column("a").to_numpy().astype(np.int64) << 32 | known.column("b").to_numpy().astype(np.int64)
        order = np.argsort(keys)
        keys, n, best = keys[order], known.column("n").to_numpy()[order], known.column("best").to_numpy()[order]
        sums: list[np.ndarray] = []
        for batch in mine.to_batches(max_chunksize=256):
            a, b, times = (np.frombuffer(raw_bytes(batch.column(c)), "<u4").astype(np.int64) for c in ("a", "b", "times"))
            at = np.searchsorted(keys, a << 32 | b)
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("a")).to_numpy() // 4)])
            running = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * n[at])]
            sums.append(np.array([np.diff(r[ends]) for r in running], dtype=np.int64))
        n_best, count_sum = np.concatenate(sums, axis=1) if sums else np.zeros((2, 0), np.int64)
        names = ["id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*(mine.column(c) for c in names), pa.array(n_best), pa.array(count_sum), mine.column("groups_sha256")], [*names, "n_best", "count_sum", "groups_sha256"])

    schema = with_fields(rows.select("id"), "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    return aligned.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema).withColumnRenamed("id", id)


def raw_bytes(column: pa.Array) -> bytes:
    """The values of a binary column, one after the other."""
    return b"".join(column.to_pylist())
