"""Splitting, connecting and merging streams. A side output is a row with a tag; consumers filter on it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def connect(
    left: DataFrame,
    right: DataFrame,
    map_left: Callable[[DataFrame], DataFrame],
    map_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different types, one function each, one output."""
    return map_left(left).unionByName(map_right(right))


def tag_union(**inputs: DataFrame) -> DataFrame:
    """Connected streams as one DataFrame with a ``src`` column; columns an input lacks are null."""
    tagged = [df.withColumn("src", F.lit(name)) for name, df in inputs.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def split(df: DataFrame, outputs: dict[str, Column], otherwise: str | None = None) -> DataFrame:
    """Give each row the name of the first output whose condition holds (else ``otherwise``) as ``tag``."""
    tag = None
    for name, cond in outputs.items():
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    return df.withColumn("tag", tag.otherwise(F.lit(otherwise)))


def split_multi(df: DataFrame, outputs: dict[str, Column]) -> DataFrame:
    """Give each row the names of all outputs whose condition holds as ``tags ARRAY<STRING>``."""
    names = [F.when(cond, F.lit(name)) for name, cond in outputs.items()]
    return df.withColumn("tags", F.array_compact(F.array(*names)))


def select_output(df: DataFrame, name: str) -> DataFrame:
    if "tags" in df.columns:
        return df.where(F.array_contains("tags", name)).drop("tags")
    return df.where(F.col("tag") == name).drop("tag")


def with_side_outputs(df: DataFrame, outputs: dict[str, Column], main: str | None = "main") -> DataFrame:
    """One row per side output that takes the row and, if ``main`` is named, the row itself once more."""
    names = [F.when(cond, F.lit(name)) for name, cond in outputs.items()]
    if main:
        names.append(F.lit(main))
    return df.withColumn("tag", F.explode(F.array_compact(F.array(*names))))
