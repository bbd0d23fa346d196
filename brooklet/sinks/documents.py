"""Document index as a table ``(id, body)``: writing an id again replaces the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import md5_hex


def to_documents(df: DataFrame, name: Column, columns: list[str], order: list[str]) -> DataFrame:
    """One JSON document per id, the latest row in ``order`` winning. The id is the MD5 of ``name``."""
    rows = df.select(md5_hex(name).alias("id"), F.to_json(F.struct(*columns)).alias("body"), F.struct(*order).alias("__at"))
    return rows.groupBy("id").agg(F.max_by("body", "__at").alias("body"))


def upsert_documents(index: DataFrame, updates: DataFrame) -> DataFrame:
    """The index after the updates: new ids are added, old ids replaced."""
    fresh = updates.select("id", F.col("body").alias("__body"))
    return index.join(fresh, "id", "full").select("id", F.coalesce("__body", "body").alias("body"))
