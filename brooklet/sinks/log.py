"""Append rows to a message log: a table ``(topic, key, value)`` or, where its connector is installed, a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import key_partition


def to_log(df: DataFrame, topic: str | Column, value: Column | None = None, fmt: str = "csv", key: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows as log records. ``value`` is given, or the ``columns`` as ``csv`` or ``json``."""
    row = F.struct(*(columns or df.columns))
    body = value if value is not None else (F.to_json(row) if fmt == "json" else F.to_csv(row))
    name = F.lit(topic) if isinstance(topic, str) else topic
    none = F.lit(None).cast("string")
    return df.select(name.alias("topic"), (key.cast("string") if key is not None else none).alias("key"), body.alias("value"))


def with_partition(records: DataFrame, partitions: int) -> DataFrame:
    """Choose the log partition by the record key; records without a key go to partition 0."""
    return records.withColumn("partition", F.coalesce(key_partition(F.col("key"), partitions), F.lit(0)))


def append_log(records: DataFrame, path: str) -> None:
    records.write.mode("append").partitionBy("topic").parquet(path)
