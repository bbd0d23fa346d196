"""File sources. Schemas are always given, never inferred."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, charset: str | None = None) -> DataFrame:
    """One row ``value STRING`` per text line, blank lines too, in the given character set (UTF-8 if none).

    The reader cuts at line-feed bytes, so a character set must write ASCII characters as single bytes.
    """
    lines = spark.read.text(path)
    if charset is None:
        return lines
    if charset.upper().replace("_", "-").startswith(("UTF-16", "UTF-32", "UCS")):
        raise ValueError(f"{charset} does not keep ASCII bytes: lines cannot be split before decoding")
    raw = F.col("value").cast("binary")
    if charset.upper() in ("ISO-8859-1", "US-ASCII", "UTF-8"):
        return lines.select(F.decode(raw, charset).alias("value"))

    # Spark's own function knows no other character set.
    @F.arrow_udf(T.StringType())
    def decoded(batch: pa.Array) -> pa.Array:
        return pa.array([b.decode(charset, "replace") for b in batch.to_pylist()], pa.string())

    return lines.select(decoded(raw).alias("value"))


def read_csv_table(spark: SparkSession, path: str, schema: str | T.StructType, view: str | None = None, sep: str = ",") -> DataFrame:
    """A CSV table with a declared schema, registered under ``view`` if given."""
    df = spark.read.schema(schema).csv(path, sep=sep)
    if view:
        df.createOrReplaceTempView(view)
    return df


def watch_dir(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the lines of every file that appears in a folder (also stands in for a line socket)."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def watch_csv(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int = 1) -> DataFrame:
    """Paced replay of CSV files: ``files_per_batch`` files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).csv(path)


def elements(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """Inline rows."""
    return spark.createDataFrame(rows, schema)


def sequence(spark: SparkSession, first: int, last: int) -> DataFrame:
    """``n LONG`` from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", "n")


def key_range(df: DataFrame, column: str, block: int = 100_000) -> DataFrame:
    """``n LONG``: every number from 0 to the largest value of ``column``, made block by block."""
    top = df.agg(F.max(column).cast("long").alias("top"))
    starts = top.select("top", F.explode(F.sequence(F.lit(0).cast("long"), F.col("top"), F.lit(block).cast("long"))).alias("s"))
    spread = starts.repartition("s")
    return spread.select(F.explode(F.sequence("s", F.least(F.col("s") + block - 1, F.col("top")))).alias("n"))
