"""Database sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """How to read a table in parallel: a numeric or time column, its range and the number of readers."""

    column: str
    lower: str
    upper: str
    readers: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.readers),
        }


def jdbc_options(url: str, source: str, split: Split | None = None, **extra: str) -> dict[str, str]:
    """Reader options. ``source`` is a table or a query; a split read needs it as ``dbtable``."""
    options = {"url": url, "fetchsize": "10000", **extra}
    is_query = source.lstrip().lower().startswith(("select", "with"))
    if split is None:
        options["query" if is_query else "dbtable"] = source
    else:
        options["dbtable"] = f"({source}) src" if is_query else source
        options.update(split.options())
    return options


def read_jdbc(spark: SparkSession, url: str, source: str, split: Split | None = None, **extra: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, source, split, **extra)).load()


def as_field_maps(df: DataFrame, out: str = "fields") -> DataFrame:
    """Each row as one map ``column -> text``, for readers that know the columns only at run time."""
    entries = [x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.create_map(*entries).alias(out))
