"""Harmonic packing of token ids into sequences of fixed capacity.

A piece of length in (capacity / (k + 1), capacity / k] is of class k, and a sequence of class k takes exactly k
pieces. Each task fills the sequences of each class on its own, holding at most one open sequence per class. A
document is cut into full sequences and a rest; a rest that would leave more than ``slack`` of its place empty
gives up a piece that fills a place of the next class whole, and so on. The open sequences at the end of the
tasks are filled up in fewer tasks, then in one; what is open after that, at most one sequence per class, is
put together by first fit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.textkit import byte_slices, with_fields
from brooklet.llm.tokens import Encoder
from brooklet.session import scratch

PIECE = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def cut_rest(length: int, capacity: int, slack: float) -> list[int]:
    """Lengths of the pieces of a rest shorter than the capacity."""
    pieces = []
    while length:
        k = capacity // length
        place = capacity // k
        if place - length <= slack * place:
            pieces.append(length)
            break
        pieces.append(capacity // (k + 1))
        length -= pieces[-1]
    return pieces


class _Packer:
    """Open sequences by class. A piece is (id, start, length, ids, doc_tokens)."""

    def __init__(self, capacity: int, level: int):
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}
        self.next_id = level << 56 | TaskContext.get().partitionId() << 28
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for piece in pieces:
            self.done.append((*piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1

    def add(self, piece: tuple) -> None:
        k = self.capacity // piece[2]
        pieces = self.open.setdefault(k, [])
        pieces.append(piece)
        if len(pieces) == k:
            self._close(self.open.pop(k))

    def leave(self) -> None:
        """Give out what is open, not yet placed."""
        for k in sorted(self.open):
            self.done.extend((*piece, None, None) for piece in self.open[k])
        self.open = {}

    def close_all(self) -> None:
        """Put the open sequences together by first fit, longest first."""
        bins: list[list] = []
        for pieces in sorted(self.open.values(), key=lambda p: (-sum(x[2] for x in p), p[0][2])):
            size = sum(p[2] for p in pieces)
            home = next((b for b in bins if b[0] + size <= self.capacity), None)
            if home is None:
                bins.append(home := [0, []])
            home[0] += size
            home[1].extend(pieces)
        for _, pieces in bins:
            self._close(pieces)
        self.open = {}

    def take(self, id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*self.done)) if self.done else [[]] * 7
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *_TYPES])], names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 2048, slack: float = 0.03, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers, ``start`` its place in the document,
    ``doc_tokens`` the document's ids with ``end_id``, which ends every document. ``offset`` is gapless from 0
    in each sequence, no sequence is longer than ``capacity``. Null and empty texts are their end id alone.
    An empty table gives no rows. Repeated rows, also of one id, are packed one by one. Other columns are not
    read.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "packing")
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = ", ".join([f"id {rows.dtypes[0][1]}", PIECE])
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, id_type = Encoder.of(tokenizer), _Packer(capacity, 1), None
        for whole in batches:
            id_type = whole.column("id").type
            for batch in byte_slices(whole, "text"):
                ends, ids = encoder.encode(batch.column("text"))
                all_ids = np.insert(ids.astype("<u4"), ends[1:], end_id)
                bounds = ends + np.arange(len(ends))
                for i, doc in enumerate(batch.column("id").to_pylist()):
                    a, total = int(bounds[i]), int(bounds[i + 1] - bounds[i])
                    start = 0
                    for length in [capacity] * (total // capacity) + cut_rest(total % capacity, capacity, slack):
                        packer.add((doc, start, length, all_ids[a + start : a + start + length].tobytes(), total))
                        start += length
                yield packer.take(id_type, names)
        if id_type is not None:
            packer.leave()
            yield packer.take(id_type, names)

    def again(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer, id_type = _Packer(capacity, level), None
            for batch in batches:
                id_type = batch.column(0).type
                for piece in zip(*(c.to_pylist() for c in batch.columns[:5])):
                    packer.add(piece)
                yield packer.take(id_type, names)
            if id_type is not None:
                packer.close_all() if last else packer.leave()
                yield packer.take(id_type, names)

        return run

    def keep(found: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        open_ = F.col("sequence_id").isNull()
        found.withColumn("open", open_).write.partitionBy("open").option("compression", "zstd").parquet(f"{folder}/{level}")
        table = spark.read.schema(with_fields(found, "open boolean")).parquet(f"{folder}/{level}")
        return table.where("NOT open").drop("open"), table.where("open").drop("open")

    placed, rest = keep(rows.mapInArrow(first, schema), 1)
    tasks = math.ceil(math.sqrt(rest.count() / 4000))
    if tasks > 1:
        more, rest = keep(rest.repartition(tasks).mapInArrow(again(2, False), schema), 2)
        placed = placed.unionByName(more)
    final = rest.coalesce(1).mapInArrow(again(3, True), schema)
    return placed.unionByName(final).withColumnRenamed("id", id)
