"""Benchmark decontamination: a broadcast hash set of test n-grams against every window of every document.

A window is ``size`` consecutive words of an item; an item with fewer words is one window. The hashes of all
windows go to the executors in blocks of a checked size; a benchmark that needs more than one block is scanned
block by block over all documents, and the hits are merged by document. A hash that hits is verified by its
words. Every document word inside an occurrence of a window counts as hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import ALNUM, Words, _spans, byte_slices, fresh, lists, small_enough, with_fields, words
from brooklet.session import saved

BLOCK_BYTES = 16 << 20  # item text that one block may hold
_OTHER_BASE = 0xC2B2AE3D27D4EB4F
CELLS = 64  # parts of a block that are weighed when blocks are filled


class WindowSet:
    """Windows of some items, as arrays: by length their sorted hashes, and of each where its words stand in the items'
    bytes and which items have it. About ten bytes for a byte of text."""

    def __init__(self, ids: pa.Array, texts: pa.Array, size: int):
        self.ids = ids
        pieces = [words(s.column("t"), ALNUM) for s in byte_slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t")]
        counts = np.concatenate([w.counts for w in pieces]) if pieces else np.zeros(0, np.int64)
        begins = np.cumsum([0, *(len(w.data) for w in pieces)])
        self.data = np.concatenate([w.data for w in pieces]) if pieces else np.zeros(0, np.uint8)
        self.starts, self.ends = (np.concatenate([getattr(w, side) + b for w, b in zip(pieces, begins)]).astype(np.int64 if begins[-1] >> 31 else np.int32) if pieces else np.zeros(0, np.int32) for side in ("starts", "ends"))
        lengths = np.minimum(counts, size)
        # For every length: hashes of the distinct windows, a place of each, and where its items begin in ``items``.
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(lengths[lengths > 0]).tolist():
            found, first_word, first_item = [], 0, 0
            for w in pieces:
                at, hashes = w.grams(n)
                item = np.searchsorted(w.offsets, at, "right") - 1
                keep = lengths[first_item + item] == n
                other = _spans(w.hashes, _OTHER_BASE, at, at + n)  # 128 bits tell windows apart here
                found.append((hashes[keep], other[keep], (at[keep] + first_word).astype(np.int32), (item[keep] + first_item).astype(np.int32)))
                first_word, first_item = first_word + len(w.starts), first_item + len(w.counts)
            hashes, other, place, item = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((item, other, hashes))
            hashes, other, place, item = hashes[order], other[order], place[order], item[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (other[1:] != other[:-1]))
            own = new | np.append(True, item[1:] != item[:-1])
            heads = np.flatnonzero(new)
            self.windows[n] = hashes[heads], place[heads], np.append(np.searchsorted(np.flatnonzero(own), heads), own.sum()).astype(np.int32), item[own]

    def _joined(self, first: int, last: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(first, last))

    @property
    def nbytes(self) -> int:
        return self.data.nbytes + self.starts.nbytes + self.ends.nbytes + sum(x.nbytes for w in self.windows.values() for x in w)

    def scan(self, column: pa.Array) -> tuple[Words, list[list], np.ndarray]:
        """The words of the texts, the items found in each text, and for every word whether it is hit."""
        found = words(column, ALNUM)
        texts = len(found.counts)
        change = np.zeros(len(found.starts) + 1, dtype=np.int64)
        items: list[set] = [set() for _ in range(texts)]
        for n, (hashes, place, begins, item) in self.windows.items():
            at, grams = found.grams(n)
            near = np.searchsorted(hashes, grams)
            hit = np.flatnonzero(hashes[np.minimum(near, len(hashes) - 1)] == grams)
            for a, w in zip(at[hit].tolist(), near[hit].tolist()):
                wanted, h = found.joined(a, a + n), hashes[w]
                while w < len(hashes) and hashes[w] == h:
                    if self._joined(place[w], place[w] + n) == wanted:
                        change[a] += 1
                        change[a + n] -= 1
                        items[int(np.searchsorted(found.offsets, a, "right")) - 1].update(item[begins[w] : begins[w + 1]].tolist())
                    w += 1
        hit = np.cumsum(change[:-1]) > 0
        return found, [sorted(set(self.ids.take(pa.array(sorted(i), pa.int32())).to_pylist()), key=str) for i in items], hit


def deal_blocks(listed: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The distinct rows ``item, text`` in blocks of at most ``block_bytes`` of text; only a part of the hash that
    holds more by itself, as one longer item does, makes a larger block."""
    listed = saved(listed.distinct(), "benchmark")
    total = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total <= block_bytes:
        return [listed]
    cell = F.pmod(F.xxhash64("item", "text"), F.lit(CELLS * (1 + total // block_bytes)))
    bounds, held = [0], 0
    for name, size in sorted(tuple(r) for r in listed.groupBy(cell).agg(F.sum(F.octet_length("text"))).collect()):
        if held and held + size > block_bytes:
            bounds.append(name)
            held = 0
        held += size
    ends = [*bounds[1:], CELLS * (1 + total // block_bytes)]
    return [listed.where((cell >= a) & (cell < b)) for a, b in zip(bounds, ends)]


def _scan_block(rows: DataFrame, block: DataFrame, size: int, item_type: str) -> tuple[DataFrame, Broadcast]:
    """``rows`` has ``id, key, text``. Returns ``id, key, n_words, hit_words, items``: positions of the words hit;
    and what was broadcast for it."""
    listed = block.select("item", "text").toArrow().combine_chunks()
    columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in listed.columns]
    shared = rows.sparkSession.sparkContext.broadcast(WindowSet(*columns, size))
    schema = with_fields(rows.select("id", "key"), f"n_words bigint, hit_words array<int>, items array<{item_type}>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                found, items, hit = shared.value.scan(batch.column("text"))
                at = np.flatnonzero(hit)
                offsets = np.searchsorted(at, found.offsets)
                of = np.searchsorted(found.offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("key"),
                        pa.array(found.counts, pa.int64()),
                        lists(pa.array(at - found.offsets[of], pa.int32()), offsets),
                        pa.array(items, pa.list_(ITEM_TYPES[item_type])),
                    ],
                    ["id", "key", "n_words", "hit_words", "items"],
                )

    return rows.mapInArrow(run, schema), shared


ITEM_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 13, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: ``id, key, n_words, hit_words, items, contaminated``.

    ``key`` is the hash of the text, ``hit_words`` are the positions of the hit words, ``items`` the ids of the
    items with a window that occurs, sorted as strings. A document is contaminated if at least one word in
    twenty is hit. Null and empty texts have no words; an item without words has no window; without items or
    without documents nothing is hit. Repeated rows are judged alike. Other columns are not looked at.
    """
    item_type = benchmark.select(item).dtypes[0][1]
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    listed = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    blocks = deal_blocks(listed, block_bytes)
    if len(blocks) == 1:
        found, _ = _scan_block(rows, blocks[0], size, item_type)
    else:
        # Rows that share id and text give the same hits; the number of words brings the repeated rows back.
        more = []
        for i, block in enumerate(blocks):  # one after the other: a task holds one block
            part, shared = _scan_block(rows, block, size, item_type)
            more.append(saved(part.where(F.size("items") > 0) if i else part, f"contamination-{i}"))
            shared.destroy()
        hits = more[0]
        merged = None
        for p in more:
            one = p.where(F.size("items") > 0).select("id", "key", "hit_words", "items")
            merged = one if merged is None else merged.unionByName(one)
        merged = merged.groupBy("id", "key").agg(F.collect_set("hit_words").alias("h"), F.collect_set("items").alias("i"))
        merged = merged.select(
            F.col("id").alias("mid"), F.col("key").alias("mkey"), F.array_sort(F.array_distinct(F.flatten("h"))).alias("hit_words"), F.array_distinct(F.flatten("i")).alias("items")
        )
        by_name = F.transform(F.array_sort(F.transform("items", lambda x: F.struct(x.cast("string").alias("s"), x.alias("x")))), lambda s: s["x"])
        found = hits.select("id", "key", "n_words").join(merged, F.col("id").eqNullSafe(F.col("mid")) & (F.col("key") == F.col("mkey")), "left")
        empty = F.array().cast("array<int>"), F.array().cast(f"array<{item_type}>")
        found = found.select("id", "key", "n_words", F.coalesce("hit_words", empty[0]).alias("hit_words"), F.coalesce(by_name, empty[1]).alias("items"))
    hit = F.size("hit_words")
    return found.select(F.col("id").alias(id), "key", "n_words", "hit_words", "items", ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents, or with ``remove="spans"`` all documents without the hit words.

    The columns stay as they are. A span runs from the first byte of its first hit word to the last byte of its
    last one; what surrounds it stays. Rows are known by id and text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = find_contamination(docs, benchmark, id, text, **options)
    own_id, own_key, hits = (fresh(docs, n) for n in ("hit_id", "hit_key", "hit_words"))
    match = docs[id].eqNullSafe(F.col(own_id)) & F.xxhash64(docs[text]).eqNullSafe(F.col(own_key))
    named = F.col(id).alias(own_id), F.col("key").alias(own_key)
    if remove == "documents":
        gone = saved(found.where("contaminated").select(*named).distinct(), "contaminated")
        return docs.join(small_enough(gone), match, "left_anti")
    spans = saved(found.where(F.size("hit_words") > 0).select(*named, F.col("hit_words").alias(hits)).distinct(), "contaminated-spans")
    joined = docs.join(spans, match, "left").drop(own_id, own_key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, positions = batch.column(text), batch.column(hits).to_pylist()
            found = words(texts, ALNUM)
            raw = texts.to_pylist()
            base = 0
            for i, h in enumerate(positions):
                data = (raw[i] or "").encode()
                if h:
                    at = np.array(h) + found.offsets[i]
                    first = at[np.diff(at, prepend=-9) != 1]
                    last = at[np.diff(at, append=at[-1] + 9) != 1]
                    pieces, done = [], 0
                    for a, b in zip((found.starts[first] - base).tolist(), (found.ends[last] - base).tolist()):
                        pieces.append(data[done:a])
                        done = b
                    raw[i] = b"".join([*pieces, data[done:]]).decode()
                base += len(data)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, text, pa.array(raw, texts.type)).drop_columns([hits])

    return joined.mapInArrow(cut, docs.schema)
