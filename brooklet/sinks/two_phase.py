"""A stream sink with a commit in two phases, for a folder of Parquet files.

Every task writes a file under ``files`` and answers with its name. The driver commits an epoch by one new file under
``epochs`` that lists the names; readers take listed files only. A task or epoch that fails leaves nothing that a
reader sees, and its files are deleted; an epoch that is replayed after its commit is answered as done, and what its
tasks have written again is deleted. A task that is killed cannot tidy up: ``sweep`` deletes what it has left.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

FORMAT = "two_phase_files"


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    rows: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class TwoPhaseWriter(DataSourceStreamArrowWriter):
    """``path`` is a folder that driver and executors share; ``writer`` names the stream among those that write there."""

    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        name, out, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if out is None:
                    store.create_dir(f"{root}/files", recursive=True)
                    out = pq.ParquetWriter(f"{root}/files/{name}", batch.schema, filesystem=store)
                out.write_batch(batch)
                rows += batch.num_rows
        except BaseException:
            if out is not None:
                out.close()
                store.delete_file(f"{root}/files/{name}")
            raise
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def _epoch(self, root: str, batch_id: int) -> str:
        return f"{root}/epochs/{self.writer}-{batch_id}.json"

    def commit(self, messages, batchId) -> None:
        store, root = _store(self.path)
        target = self._epoch(root, batchId)
        if store.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        store.create_dir(f"{root}/epochs", recursive=True)
        listed = [{"name": m.name, "rows": m.rows} for m in messages if m is not None and m.name]
        draft = f"{root}/epochs/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({"writer": self.writer, "epoch": batchId, "files": listed}).encode())
        store.move(draft, target)

    def abort(self, messages, batchId) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m is not None and m.name:
                store.delete_file(f"{root}/files/{m.name}")


class TwoPhaseFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> TwoPhaseWriter:
        return TwoPhaseWriter(self.options["path"], self.options.get("writer", "stream"))


def two_phase(df: DataFrame, path: str, checkpoint: str, writer: str = "stream", **trigger) -> DataStreamWriter:
    """A writer of the stream ``df`` into ``path``; call ``start``."""
    df.sparkSession.dataSource.register(TwoPhaseFiles)
    out = df.writeStream.format(FORMAT).option("path", path).option("writer", writer).option("checkpointLocation", checkpoint)
    return out.trigger(**(trigger or {"availableNow": True}))


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed epochs."""
    store, root = _store(path)
    if store.get_file_info(f"{root}/epochs").type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    epochs = spark.read.schema("files array<struct<name:string>>").json(f"{path}/epochs")
    names = [r["name"] for r in epochs.selectExpr("inline(files)").collect()]  # file names, as any file source lists them
    return spark.read.schema(schema).parquet(*[f"{path}/files/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def sweep(path: str, older_than_s: float = 86_400) -> int:
    """Delete the files that no epoch lists and that are older than any running epoch; returns how many."""
    store, root = _store(path)
    listed = set()
    for epoch in store.get_file_info(fs.FileSelector(f"{root}/epochs", allow_not_found=True)):
        if epoch.base_name.endswith(".json"):
            with store.open_input_stream(epoch.path) as kept:
                listed |= {f["name"] for f in json.loads(kept.read())["files"]}
    found = store.get_file_info(fs.FileSelector(f"{root}/files", allow_not_found=True))
    lost = [f.path for f in found if f.base_name not in listed and f.mtime.timestamp() <= time.time() - older_than_s]
    for name in lost:
        store.delete_file(name)
    return len(lost)
