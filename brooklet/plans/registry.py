"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.session import STATE_STORE, scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOUR = 3_600_000
DAY = 24 * HOUR

# Arrival order with made lateness: every tenth event arrives 40 events later.
SQL_EVENTS = "(SELECT *, epoch_us(ts) // 1000 AS ms, event_id + CASE WHEN event_id % 10 = 0 THEN 40 ELSE 0 END AS arrival FROM events)"


class Tables:
    """The parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def arrivals(self) -> DataFrame:
        delay = F.when(F.col("event_id") % 10 == 0, F.lit(40)).otherwise(F.lit(0))
        return self.events.withColumn("arrival", F.col("event_id") + delay)

    def stream(self, name: str) -> DataFrame:
        """A table as a stream. The glob lets the path be one file or a folder of files."""
        schema = self.__getattr__(name).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/{name}.parquet*")

    def fresh_path(self, name: str) -> str:
        """A new folder for files derived from the tables."""
        return scratch(self.spark, name)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``fn(tables)`` under ``name``, with its SQL if it has one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
