"""Exactly-once output of a stream into a table of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that gives each batch its own folder, which a replay overwrites."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def tagged_files(path: str, tags: list[str], tag: str = "tag") -> Callable[[DataFrame, int], None]:
    """The same with one table per side output, all from one pass over the batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.where(batch[tag].isin(*tags))
        kept.write.mode("overwrite").partitionBy(tag).parquet(f"{path}/batch_id={batch_id}")

    return write


def write_stream(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", **trigger) -> StreamingQuery:
    """Start a stream into ``sink``. The checkpoint holds offsets and state, so a restart goes on where it stopped."""
    writer = df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")


def latest_state(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The last emission per key of an update-mode stream written with :func:`batch_files`."""
    newest: Column = F.max_by(F.struct(*values), F.col("batch_id")).alias("__v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "__v.*")
