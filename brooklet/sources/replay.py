"""Files replayed as a stream, by rows: every partition has an offset, a rate and a limit of its own.

A partition is a folder of Parquet files (``topic=a/partition=3``, or the root itself); its rows are numbered in the order
of file names. A micro-batch is a range of row numbers of each partition, so a restart from the checkpoint reads the
very same rows again, and the pace is in rows a second. The numbers of rows come from the footers of the files.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "paced_replay"


class Range(InputPartition):
    """Rows ``first`` to ``last`` (excluded) of the files of a partition."""

    def __init__(self, partition: str, files: list[tuple[str, int]], first: int, last: int):
        self.partition, self.files, self.first, self.last = partition, files, first, last


class ReplayReader(DataSourceStreamReader):
    """Options: ``path``; ``rowsPerBatch`` and ``rowsPerSecond`` of each partition (none: all there are);
    ``progress``, a file that keeps the ranges planned last, for a restart."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.path, self.progress = options["path"], options["progress"]
        self.per_batch = int(options.get("rowsPerBatch", 0))
        self.per_second = float(options.get("rowsPerSecond", 0))
        self.since = time.time()
        self.sizes: dict[str, int] = {}
        store, where = fs.FileSystem.from_uri(self.progress)
        self.planned: dict[str, int] = {}
        if store.get_file_info(where).type != fs.FileType.NotFound:
            with store.open_input_stream(where) as kept:
                self.planned = json.loads(kept.read())

    def _files(self) -> dict[str, list[tuple[str, int]]]:
        """By partition its files and their numbers of rows."""
        store, root = fs.FileSystem.from_uri(self.path)
        found: dict[str, list[tuple[str, int]]] = {}
        names = sorted(f.path for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.path.endswith(".parquet"))
        for name in names:
            if name not in self.sizes:
                with store.open_input_file(name) as file:
                    self.sizes[name] = pq.read_metadata(file).num_rows
            found.setdefault(name[len(root) :].rpartition("/")[0].strip("/") or ".", []).append((name, self.sizes[name]))
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        now = time.time()
        allowed = None
        if self.per_second:
            allowed = int(self.per_second * (now - self.since))
            if not allowed:
                return dict(self.planned)
            self.since += allowed / self.per_second
        if self.per_batch:
            allowed = self.per_batch if allowed is None else min(allowed, self.per_batch)
        latest = {}
        for partition, files in self._files().items():
            rows, done = sum(n for _, n in files), self.planned.get(partition, 0)
            latest[partition] = rows if allowed is None else min(rows, done + allowed)
        return {**self.planned, **latest}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        store, where = fs.FileSystem.from_uri(self.progress)
        self.planned = {p: max(n, self.planned.get(p, 0)) for p, n in end.items()}
        draft = f"{where}.draft"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(self.planned).encode())
        store.move(draft, where)
        files = self._files()
        return [Range(p, files[p], start.get(p, 0), n) for p, n in sorted(end.items()) if n > start.get(p, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        fixed = dict(part.split("=", 1) for part in partition.partition.split("/") if "=" in part)
        schema = to_arrow_schema(self.schema)
        begin = 0
        for name, rows in partition.files:
            low, high = max(partition.first - begin, 0), min(partition.last - begin, rows)
            begin += rows
            if low >= high:
                continue
            with store.open_input_file(name) as source:
                file, at = pq.ParquetFile(source), 0
                wanted = [f.name for f in schema if f.name not in fixed]
                for group in range(file.num_row_groups):
                    size = file.metadata.row_group(group).num_rows
                    first, last = max(low - at, 0), min(high - at, size)
                    at += size
                    if first >= last:
                        continue
                    table = file.read_row_group(group, columns=wanted).slice(first, last - first)
                    columns = [pa.array([fixed[f.name]] * len(table)).cast(f.type) if f.name in fixed else table.column(f.name).cast(f.type) for f in schema]
                    yield from pa.table(columns, schema=schema).to_batches(max_chunksize=10_000)

    def commit(self, end: dict) -> None:
        pass


class PacedReplay(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("name the schema of the files")

    def streamReader(self, schema: T.StructType) -> ReplayReader:
        return ReplayReader(schema, {k: self.options[k] for k in ("path", "progress", "rowsPerBatch", "rowsPerSecond") if self.options.get(k)})


def replay_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, progress: str, rows_per_batch: int | None = None, rows_per_second: float | None = None
) -> DataFrame:
    """The Parquet files under ``path`` as a paced stream. ``progress`` names a file of this query alone, next to its
    checkpoint; both limits hold for each partition. Folder names give the columns they name."""
    spark.dataSource.register(PacedReplay)
    reader = spark.readStream.format(FORMAT).schema(schema).option("path", path).option("progress", progress)
    if rows_per_batch:
        reader = reader.option("rowsPerBatch", rows_per_batch)
    if rows_per_second:
        reader = reader.option("rowsPerSecond", rows_per_second)
    return reader.load()
