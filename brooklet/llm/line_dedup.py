"""Lines that several documents hold stay in the first of them only.

The hashes of all long lines go through two Bloom filters. A slice of the hash space is one task's: a hash that
may be in its *once* filter, or that one batch has already met in two documents, is put into its *twice* filter.
The once filters take ``ONCE_BITS`` bits per possible line in slices of a megabyte and stay with their tasks. The
twice filter is ``FEWER`` times smaller, at most ``TWICE_BITS`` bits, and goes to all tasks: a fuller filter
suspects more lines, it never misses one. Only lines that it suspects are shuffled with their text, grouped by it and
given to their first document. Hashes decide nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import LOWER, NOT_BLANK, byte_slices, mix, raw_texts, span_hashes, with_fields
from brooklet.session import saved

ONCE_BITS, SLICE_BITS, FEWER = 8, 1 << 23, 16
TWICE_BITS = 1 << 29
PROBES = 2
LEAST_HOT, HOT_TEXTS = 1_000, 100_000  # lines of one text that is told to all tasks; how many such texts at most


class Lines:
    """The lines of some texts: text of each, its place there, and the key's byte range, length and hash."""

    def __init__(self, column: pa.Array):
        raw, offsets = raw_texts(column)
        self.data = LOWER[raw]
        # A text has one line more than it has line feeds.
        feeds = np.flatnonzero(self.data == 10)
        of_text = np.searchsorted(offsets, feeds, "right") - 1
        counts = np.bincount(of_text, minlength=len(offsets) - 1) + 1
        self.text = np.repeat(np.arange(len(offsets) - 1), counts)
        first = np.cumsum(counts) - counts
        self.place = np.arange(len(self.text)) - first[self.text]
        ends = np.zeros(len(self.text), np.int64)
        ends[first + counts - 1] = offsets[1:]
        ends[np.arange(len(feeds)) + of_text] = feeds
        starts = np.zeros(len(self.text), np.int64)
        starts[first] = offsets[:-1]
        starts[np.arange(len(feeds)) + of_text + 1] = feeds + 1
        solid = np.flatnonzero(NOT_BLANK[self.data])
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        some = np.flatnonzero(low < high)
        self.starts, self.ends = starts.copy(), starts.copy()
        if len(some):
            self.starts[some], self.ends[some] = solid[low[some]], solid[high[some] - 1] + 1
        points = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        self.length = points[self.ends] - points[self.starts]

    def long(self, least: int) -> np.ndarray:
        return np.flatnonzero(self.length >= least)

    def hashes(self, at: np.ndarray) -> np.ndarray:
        return span_hashes(self.data, self.starts[at], self.ends[at])


class Geometry:
    """How a hash is laid out in the filters: its slice, and its bits in the slice's part of each filter."""

    def __init__(self, possible_lines: int, once_bits: int = ONCE_BITS, slice_bits: int = SLICE_BITS, twice_bits: int = TWICE_BITS):
        slices = max(1, -(-possible_lines * once_bits // slice_bits))
        self.slice_power = (slices - 1).bit_length()
        self.once = slice_bits
        self.twice = max(8, min(slice_bits // FEWER, twice_bits >> self.slice_power))

    def slice_of(self, hashes: np.ndarray) -> np.ndarray:
        if not self.slice_power:
            return np.zeros(len(hashes), np.int64)
        return (hashes >> np.uint64(64 - self.slice_power)).astype(np.int64)

    @staticmethod
    def bits(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        return [(mix(hashes + np.uint64(i + 1)) % np.uint64(size)).astype(np.int64) for i in range(PROBES)]


class Twice:
    """The twice filter as a whole."""

    def __init__(self, geometry: Geometry, parts: list[tuple[int, bytes]]):
        self.geometry = geometry
        self.bytes = np.zeros((geometry.twice + 7 >> 3) << geometry.slice_power, np.uint8)
        for number, bits in parts:
            at = number * (geometry.twice + 7 >> 3)
            self.bytes[at : at + len(bits)] = np.frombuffer(bits, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        base = self.geometry.slice_of(hashes) * (8 * (self.geometry.twice + 7 >> 3))
        found = np.ones(len(hashes), dtype=bool)
        for bit in self.geometry.bits(hashes, self.geometry.twice):
            at = base + bit
            found &= (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def _twice_filter(docs: DataFrame, text: str, least: int, geometry: Geometry) -> Twice:
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text", 8_000_000):
                lines = Lines(batch.column("text"))
                at = lines.long(least)
                hashes, owner = lines.hashes(at), lines.text[at]
                order = np.lexsort((owner, hashes))
                hashes, owner = hashes[order], owner[order]
                new = np.ones(len(hashes), dtype=bool)
                new[1:] = hashes[1:] != hashes[:-1]
                first = np.flatnonzero(new)
                several = np.maximum.reduceat(owner, first) != owner[first] if len(first) else np.zeros(0, bool)
                own = hashes[first]
                yield pa.RecordBatch.from_arrays([pa.array(geometry.slice_of(own), pa.int64()), pa.array(own.view(np.int64)), pa.array(several)], ["slice", "hash", "several"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice, current = np.zeros(geometry.once, bool), np.zeros(geometry.twice, bool), None

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

        for batch in batches:
            numbers = batch.column("slice").to_numpy()
            for number in np.unique(numbers).tolist():
                if number != current:
                    if current is not None:
                        yield part()
                    once[:], twice[:], current = False, False, number
                mine = numbers == number
                hashes, n = np.unique(batch.column("hash").to_numpy()[mine].view(np.uint64), return_counts=True)
                several = batch.column("hash").to_numpy()[mine & batch.column("several").to_numpy(zero_copy_only=False)].view(np.uint64)
                bits = geometry.bits(hashes, geometry.once)
                again = hashes[np.logical_and.reduce([once[b] for b in bits]) | (n > 1)]
                for seen in (again, several):
                    for bit in geometry.bits(seen, geometry.twice):
                        twice[bit] = True
                for bit in bits:
                    once[bit] = True
        if current is not None:
            yield part()

    hashes = docs.select(F.col(text).alias("text")).mapInArrow(met, "slice bigint, hash bigint, several boolean")
    dealt = hashes.repartition("slice").sortWithinPartitions("slice")
    parts = dealt.mapInArrow(build, "slice bigint, bits binary").toArrow()  # TWICE_BITS at most
    return Twice(geometry, list(zip(parts.column("slice").to_pylist(), parts.column("bits").to_pylist())))


def find_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 10, geometry: Geometry | None = None) -> DataFrame:
    """``id, digest, line``: every line to drop, by the id and the hash of the text that holds it, from line 0.

    A line's key is the line without blanks at both ends, A-Z in lower case. Keys of at least ``least`` code
    points that occur under two ids or more lose all their lines but those under the smallest id; null is the
    largest id. Rows that repeat an id are one document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("text"))
    if geometry is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        geometry = Geometry(size // (least + 1))
    shared = spark.sparkContext.broadcast(_twice_filter(rows, "text", least, geometry))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                lines = Lines(batch.column("text"))
                at = lines.long(least)
                at = at[shared.value.has(lines.hashes(at))]
                # The keys, cut out of the bytes of all texts.
                sizes = lines.ends[at] - lines.starts[at]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                from_ = np.repeat(lines.starts[at] - bounds[:-1], sizes) + np.arange(bounds[-1])
                keys = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(lines.data[from_].tobytes())).cast(pa.string())
                owner = pa.array(lines.text[at])
                yield pa.RecordBatch.from_arrays([batch.column("id").take(owner), batch.column("digest").take(owner), pa.array(lines.place[at], pa.int32()), keys], ["id", "digest", "line", "key"])

    suspects = saved(rows.mapInArrow(suspect, with_fields(rows.select("id", "digest"), "line int, key string")), "lines-suspected")
    who = F.struct(F.col("id").isNull().alias("none"), "id")
    held = suspects.groupBy("key").agg(F.min(who).alias("first"), F.max(who).alias("last"), F.count("*").alias("n"))
    held = saved(held.where(F.col("first") != F.col("last")).select("key", F.col("first.id").alias("first"), "n"), "lines-held")
    # Lines of one text go to one task, so texts that are on very many lines are told to all tasks, fewer than HOT_TEXTS.
    most = max(LEAST_HOT, suspects.count() // HOT_TEXTS)
    hot = F.broadcast(held.where(F.col("n") > most).drop("n"))
    found = suspects.join(hot, "key").unionByName(suspects.join(hot.select("key"), "key", "left_anti").join(held.where(F.col("n") <= most).drop("n"), "key"))
    return found.where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "digest", "line")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 10, geometry: Geometry | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id, n_lines, n_dropped, text``, the text without the lines of
    ``find_repeated_lines``. Lines end at a line feed; null and empty texts are one empty line. An empty table gives
    no rows; other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest"))
    gone = find_repeated_lines(docs, id, text, least, geometry).groupBy("id", "digest").agg(F.collect_set("line").alias("gone"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"), "gone")
    joined = rows.join(gone, rows["id"].eqNullSafe(gone["gone_id"]) & (rows["digest"] == gone["gone_digest"]), "left")
    lines = lines_of(F.col("text"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    done = joined.select("id", "text", "gone", lines.alias("lines"))
    return done.select(
        F.col("id").alias(id),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("text"),
    )
