"""Records of a message log: the column layout of ``format("kafka")``, read from a table or a live topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = ["topic", "partition", "offset"]


def decode_log(
    records: DataFrame,
    schema: str | T.StructType | None = None,
    fmt: str = "json",
    topics: list[str] | None = None,
    start_offsets: DataFrame | None = None,
    sep: str = ",",
) -> DataFrame:
    """Typed rows of a log.

    ``fmt``: ``text`` (value as a string), ``json`` or ``csv`` (fields of ``schema``). Without
    ``start_offsets`` reading starts at the earliest record; else it is a table ``(topic, partition,
    start)`` and a partition it does not list starts at the earliest. It has one row per log partition,
    so the optimizer may broadcast it by size.
    """
    df = records
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    if start_offsets is not None:
        df = (
            df.join(start_offsets.select("topic", "partition", F.col("start").alias("__start")), ["topic", "partition"], "left")
            .where(F.col("offset") >= F.coalesce("__start", F.lit(0)))
            .drop("__start")
        )
    key, value = F.col("key").cast("string").alias("key"), F.col("value").cast("string")
    if fmt == "text":
        return df.select(*META, key, value.alias("value"))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "json":
        parsed = F.from_json(value, schema)
    else:
        parsed = F.from_csv(value, schema.simpleString()[len("struct<"):-1].replace(":", " "), {"sep": sep})
    return df.select(*META, key, parsed.alias("__v")).select(*META, "key", "__v.*")


def subscribe(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest", stream: bool = True) -> DataFrame:
    """A live topic, for clusters that have the connector package; feed the result to :func:`decode_log`."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
    )
