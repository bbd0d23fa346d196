"""User functions in each kind a job can plug in. They take Arrow batches, but for the table function: Spark calls
its ``eval`` for each row, since the fields found have to stay with their row.

The operators themselves use native expressions; these are the hooks for a caller's own code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, udtf

from brooklet.functions.scalars import space_split


@arrow_udf(T.IntegerType())
def text_length(text: pa.Array) -> pa.Array:
    """Scalar function: characters of a string."""
    return pc.utf8_length(text)


@arrow_udf(T.DoubleType())
def price_total(price: pa.Array) -> float:
    """Aggregate function: the sum of a group."""
    return pc.sum(pc.cast(price, pa.float64())).as_py()


@udtf(returnType=T.StructType([T.StructField("field", T.StringType()), T.StructField("length", T.IntegerType())]))
class FieldLengths:
    """Table function: the space-separated fields of a string and their lengths in code points (a character beyond
    U+FFFF is one, where UTF-16 counts two)."""

    def eval(self, text: str):
        for field in (text or "").split(" "):
            if field:
                yield field, len(field)


def register_all(spark: SparkSession) -> None:
    """Register the functions above under SQL names."""
    spark.udf.register("text_length", text_length)
    spark.udf.register("price_total", price_total)
    spark.udtf.register("field_lengths", FieldLengths)


def field_lengths(df: DataFrame, text: str, keep: tuple[str, ...], outer: bool = False) -> DataFrame:
    """Native form of :class:`FieldLengths`; ``outer`` keeps rows without a field (nulls)."""
    fields = F.array_remove(space_split(F.col(text)), "")
    explode = F.explode_outer if outer else F.explode
    return df.select(*keep, explode(fields).alias("field")).withColumn("length", F.length("field"))


def with_resource(
    df: DataFrame,
    opener: Callable[[], object],
    step: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
    closer: Callable[[object], None] = lambda r: None,
) -> DataFrame:
    """Map batches with one resource per task, opened before the first batch and closed after the last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = opener()
        try:
            for batch in batches:
                yield step(resource, batch)
        finally:
            closer(resource)

    return df.mapInPandas(run, schema)


def table_aggregate(df: DataFrame, keys: list[str], best: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Table aggregate function: ``best`` keeps, per key, the few rows of a batch that still matter.

    It handles all keys of a batch at once and must be mergeable: applied to its own results it gives the
    result of all rows. It runs on every Arrow batch before the shuffle; after it the survivors of a key
    stream through one task in sorted order, and only those of the current key are held.
    """

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield best(batch)

    def merge_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = best(batch if held is None else pd.concat([held, batch]))
            last = batch[keys].iloc[-1]
            open_key = ((rows[keys] == last) | (rows[keys].isna() & last.isna())).all(axis=1)
            yield rows[~open_key]
            held = rows[open_key]
        if held is not None:
            yield held

    survivors = df.mapInPandas(reduce_batches, schema)
    return survivors.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(merge_batches, schema)
