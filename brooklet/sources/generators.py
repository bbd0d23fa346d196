"""Seeded test streams: expressions over a row id, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(options: list, seed: int) -> Column:
    values = F.array(*[F.lit(o) for o in options])
    return F.element_at(values, (F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(len(options))) + 1).cast("int"))


def _uniform(low: int, high: int, seed: int) -> Column:
    """An integer in ``[low, high)``."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(high - low)) + low).cast("int")


def shape(ids: DataFrame, kind: str, seed: int = 0, gap_ms: int = 1000, choices: list | None = None) -> DataFrame:
    """Turn a batch or streaming ``id LONG`` column into rows of a generator kind.

    ``goods``: keyed ints 100..199 each second. ``sensors``: ten sensors with one reading each per tick.
    ``pick``: a random choice. ``cycle``: the choices in turn.
    """
    ts = F.timestamp_millis(F.col("id") * gap_ms).alias("ts")
    if kind == "goods":
        return ids.select("id", _pick(choices or ["tea", "rice", "salt", "oil"], seed).alias("type"), _uniform(100, 200, seed + 1).alias("n"), ts)
    if kind == "sensors":
        noise = _uniform(-5000, 5001, seed) / 1000.0
        tick = F.timestamp_millis(F.floor(F.col("id") / 10) * gap_ms).alias("ts")
        return ids.select("id", F.concat(F.lit("sensor_"), F.col("id") % 10 + 1).alias("sensor"), tick, (F.lit(60.0) + noise).alias("temp"))
    if kind == "pick":
        return ids.select("id", _pick(choices, seed).alias("value"), ts)
    if kind == "cycle":
        values = F.array(*[F.lit(c) for c in choices])
        return ids.select("id", F.element_at(values, (F.col("id") % len(choices) + 1).cast("int")).alias("value"), ts)
    raise ValueError(f"unknown generator kind {kind}")


def generate(spark: SparkSession, kind: str, rows: int, seed: int = 0, **options) -> DataFrame:
    return shape(spark.range(rows), kind, seed, **options)


def generate_stream(spark: SparkSession, kind: str, rows_per_batch: int, seed: int = 0, **options) -> DataFrame:
    """The same rows as an endless stream, ``rows_per_batch`` per micro-batch."""
    ids = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return shape(ids.select(F.col("value").alias("id")), kind, seed, **options)
