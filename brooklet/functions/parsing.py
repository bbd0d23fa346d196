"""Text lines to typed rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.scalars import space_split


def split_fields(df: DataFrame, line: str, sep: str, schema: str | T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Split ``line`` on ``sep`` into the typed columns of ``schema`` and add ``tag``.

    ``tag`` is ``ok`` if the line has exactly the fields of the schema and every non-empty field casts
    to its type, else ``bad`` (then the fields are null). Columns in ``keep`` and the line are kept.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parts = F.split(F.col(line), re.escape(sep), -1)
    fields = [F.try_element_at(F.col("__parts"), F.lit(i + 1)) for i in range(len(schema.fields))]
    typed = [f.try_cast(s.dataType) for f, s in zip(fields, schema.fields)]
    ok = F.coalesce(F.size("__parts") == len(schema.fields), F.lit(False))
    for raw, value in zip(fields, typed):
        ok = ok & F.coalesce((raw == "") | value.isNotNull(), F.lit(False))
    return (
        df.select(*keep, F.col(line), parts.alias("__parts"))
        .withColumn("__ok", ok)
        .select(
            *keep,
            line,
            *[F.when(F.col("__ok"), v).alias(s.name) for v, s in zip(typed, schema.fields)],
            F.when(F.col("__ok"), F.lit("ok")).otherwise(F.lit("bad")).alias("tag"),
        )
    )


def words(df: DataFrame, line: str, keep: tuple[str, ...] = (), skip_blank: bool = False, out: str = "word") -> DataFrame:
    """One row per space-separated word. Trailing empty words are dropped, inner ones kept."""
    if skip_blank:
        df = df.where(F.length(F.trim(F.col(line))) > 0)
    return df.select(*keep, F.explode(space_split(F.col(line))).alias(out))


def cdc_rows(
    df: DataFrame,
    envelope: str,
    schema: str | T.StructType,
    types: tuple[str, ...] = ("INSERT", "UPDATE"),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows of change envelopes ``{"type": ..., "data": [{...}, ...]}``; unreadable envelopes give none."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    shape = T.StructType([T.StructField("type", T.StringType()), T.StructField("data", T.ArrayType(schema))])
    doc = df.select(*keep, F.from_json(F.col(envelope), shape).alias("__d")).where(F.col("__d.type").isin(*types))
    rows = doc.select(*keep, F.col("__d.type").alias("type"), F.explode("__d.data").alias("__r"))
    return rows.select(*keep, "type", *[F.col("__r")[f.name].alias(f.name) for f in schema.fields])


def data_maps(df: DataFrame, doc: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``data`` array of a JSON document as one string map per element."""
    raw = F.get_json_object(F.col(doc), "$.data")
    return df.select(*keep, F.explode(F.from_json(raw, "array<map<string,string>>")).alias("entry"))


def labelled(value: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))
