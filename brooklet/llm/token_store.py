"""Token ids in binary shards with Elias-Fano document boundaries.

A store is a folder of shards, written by Spark with its commit protocol. The ids of all documents, in ascending
document order, form one array that is cut into shards at document ends. A shard keeps the ids as little-endian
numbers of two or four bytes, and both the document ids and the ends of its documents in Elias-Fano form: the low bits
packed, the high bits as a unary bit vector with a sample at every 64th one. ``select`` reads one offset from
that, without a table of 64-bit offsets. Where a shard begins in the whole array follows from the shards before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.llm.textkit import byte_slices
from brooklet.llm.tokens import Encoder
from brooklet.session import scratch

SHARD_IDS = 2_000_000
SAMPLE = 64


@dataclass
class EliasFano:
    """A sequence of n numbers that never falls, each at most ``top``."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @staticmethod
    def encode(values: np.ndarray, top: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << bits) - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        parts = (low[i : i + (1 << 16)] for i in range(0, n, 1 << 16))
        packed = b"".join(np.packbits(((p[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes() for p in parts)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros(int(top >> bits) + n + 1, dtype=np.uint8)
        vector[ones] = 1
        return EliasFano(n, bits, packed, np.packbits(vector, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        window = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8], "little")
        return (window >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number, read from the sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4", 1, 4 * (i // SAMPLE))[0])
        left = i % SAMPLE
        byte = at // 8
        word = self.high[byte] >> (at % 8) << (at % 8)
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        one = 8 * byte + (word & -word).bit_length() - 1
        return (one - i) << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        if not self.low_bits:
            return high
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        return (high << self.low_bits) + low.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))


SHARD = (
    "part int, shard int, before bigint, n_docs bigint, n_ids bigint, width int, first_doc bigint, last_doc bigint, "
    "docs_bits int, docs_low binary, docs_high binary, docs_samples binary, null_docs bigint, ids binary, ends_bits int, ends_low binary, ends_high binary, ends_samples binary"
)


class _Writer:
    def __init__(self, width: int):
        self.width, self.shard, self.before = width, 0, 0
        self.part = TaskContext.get().partitionId()
        self.clear()

    def clear(self) -> None:
        self.docs: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.nulls = self.size = 0

    def add(self, docs: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.nulls += docs.null_count
        self.docs.append(docs.drop_null().to_numpy(zero_copy_only=False))
        self.lengths.append(lengths)
        self.ids.append(ids.astype(f"<u{self.width}"))
        self.size += len(ids)

    def row(self) -> pa.RecordBatch | None:
        if not self.lengths:
            return None
        docs, ends = np.concatenate(self.docs).astype("<i8"), np.cumsum(np.concatenate(self.lengths))
        fano = EliasFano.encode(ends, self.size)
        own = EliasFano.encode(docs - docs[:1], int(docs[-1]) - int(docs[0]) if len(docs) else 0)
        values = [
            self.part, self.shard, self.before, fano.n, self.size, self.width, int(docs[0]) if len(docs) else None, int(docs[-1]) if len(docs) else None,
            own.low_bits, own.low, own.high, own.samples, self.nulls, np.concatenate(self.ids).tobytes(), fano.low_bits, fano.low, fano.high, fano.samples,
        ]
        types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
        fields = [f.strip().split(" ") for f in SHARD.split(",")]
        self.shard, self.before = self.shard + 1, self.before + self.size
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], types[t]) for v, (_, t) in zip(values, fields)], [name for name, _ in fields])


def write_store(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> str:
    """Encode all texts, append ``end_id`` to each, write the store and return its folder.

    Documents are ordered by id, ties by text, null ids first. Null text is empty: its only id is ``end_id``.
    Repeated rows are written again. An empty table gives an empty store. A document is never cut, so a shard
    holds ``shard_ids`` ids or one document more. Document ids are 64-bit integers. The folder is in the
    cluster's shared folder unless ``path`` names another.
    """
    path = path or scratch(docs.sparkSession, "token-store")
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Rows that share an id, or have none, are dealt by their texts too.
    ordered = rows.withColumn("mark", F.substring("text", 1, 200)).repartitionByRange("id", "mark").sortWithinPartitions("id", "text").drop("mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        width = 2 if max(encoder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        writer = _Writer(width)
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                ends, ids = encoder.encode(batch.column("text"))
                writer.add(batch.column("id"), np.diff(ends) + 1, np.insert(ids.astype(f"<u{width}"), ends[1:], end_id))
                if writer.size >= shard_ids:
                    yield writer.row()
        if last := writer.row():
            yield last

    ordered.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(path)
    return path


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``base``: how many ids of the whole array come before the shard."""
    shards = spark.read.parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per task of the writer, so the running sum over all parts is small.
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_base"))
    return shards.join(F.broadcast(parts), "part").withColumn("base", F.col("part_base") + F.col("before"))


def _boundaries(row: dict) -> EliasFano:
    return EliasFano(row["n_docs"], row["ends_bits"], row["ends_low"], row["ends_high"], row["ends_samples"])


def _doc_ids(row: dict) -> np.ndarray:
    if row["first_doc"] is None:
        return np.zeros(0, np.int64)
    above = EliasFano(row["n_docs"] - row["null_docs"], row["docs_bits"], row["docs_low"], row["docs_high"], row["docs_samples"])
    return row["first_doc"] + above.all()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The shards one by one, whatever a batch holds."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store: ``doc_id, start, n_tokens, ids``, ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ends = _boundaries(row).all()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['width']}")
            docs = pa.concat_arrays([pa.nulls(row["null_docs"], pa.int64()), pa.array(_doc_ids(row))])
            for a in range(0, len(ends), 1000):
                b = min(a + 1000, len(ends))
                data = ids[starts[a] : ends[b - 1]].astype("<u4").tobytes()
                cuts = 4 * np.append(starts[a:b] - starts[a], ends[b - 1] - starts[a])
                values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(a, b - a), pa.array(starts[a:b] + row["base"], pa.int64()), pa.array(ends[a:b] - starts[a:b], pa.int64()), values.cast(pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return _placed(spark, path).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def fetch(spark: SparkSession, path: str, wanted: Sequence[int]) -> DataFrame:
    """The documents with the given ids, by ``select`` on the boundaries of the shards whose range holds one."""
    wanted = sorted(set(wanted))
    near = F.lit(False)
    for w in wanted:
        near = near | ((F.col("first_doc") <= w) & (F.col("last_doc") >= w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                ends, docs = _boundaries(row), _doc_ids(row)
                for w in wanted:
                    for at in range(int(np.searchsorted(docs, w)), int(np.searchsorted(docs, w, "right"))):
                        i = at + row["null_docs"]
                        a, b = ends.select(i - 1) if i else 0, ends.select(i)
                        ids = np.frombuffer(row["ids"], f"<u{row['width']}", b - a, a * row["width"])
                        out.append((w, a + row["base"], b - a, ids.astype("<u4").tobytes()))
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.binary(),))], ["doc_id", "start", "n_tokens", "ids"])

    return _placed(spark, path).where(near).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
