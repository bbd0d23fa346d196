"""Keyed state in replay form, with native expressions. State machines with timers are in ``machines``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Count, History, Last, Next, Ordered


def running_parity(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Running count per key (``total``) with ``tag`` ``even`` or ``odd``."""
    rows = Ordered(df, keys, order).scan(total=Count()).result()
    return rows.withColumn("tag", F.when(F.col("total") % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))


def value_sum(df: DataFrame, value: str) -> DataFrame:
    """Sum kept in state that is cleared after every record: each record gives itself back."""
    return df.withColumn("total", F.col(value))


def history_elements(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The long form of a history: every row once, with its ``position`` in the key's history. The history at a
    row is the rows up to its position, so nothing grows, and a key may have any number of rows."""
    return Ordered(df, keys, order).scan(position=Count()).result()


def history_list(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Every row with the list of the key's values so far: the view of ``history_elements`` for short histories.
    The output grows with the square of the longest one, and a row ends at 2 GB; that is the operator."""
    return Ordered(df, keys, order).scan(history=History(value)).result()


def changed_value(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose ``value`` differs from the key's previous row (``previous``); a first row never counts."""
    rows = Ordered(df, keys, order).scan(previous=Last(value)).result()
    return rows.where(F.col("previous") != F.col(value))


def delimited_segments(df: DataFrame, keys: list[str], order: list[str], value: str, delimiter: Column) -> DataFrame:
    """Rows between two delimiters as ``(segment, n, text)``; empty and unclosed segments are not emitted."""
    marks = Ordered(df, keys, order).scan(
        segment=Count(delimiter), __closed=Next(F.lit(True), where=delimiter)
    )
    body = marks.result().where(~delimiter & F.col("__closed"))
    items = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.col(value).alias("v"))))
    grouped = body.groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("n"), items.alias("__items"))
    return grouped.select(*keys, "segment", "n", F.array_join(F.transform("__items", lambda x: x["v"]), " ").alias("text"))


def inactivity(df: DataFrame, keys: list[str], order: list[str], ts: str, idle_ms: int) -> DataFrame:
    """The key's running count each time it stays silent for ``idle_ms``, at ``fired_ms``.

    A row exactly ``idle_ms`` later does not stop the timer: the timer is due first.
    """
    rows = Ordered(df, keys, order).scan(total=Count(), __next=Next(epoch_ms(F.col(ts))))
    now = epoch_ms(F.col(ts))
    idle = F.col("__next").isNull() | (F.col("__next") - now >= idle_ms)
    return rows.result().where(idle).withColumn("fired_ms", now + idle_ms).drop("__next")


def timer_echo(df: DataFrame, ts: str, delay_ms: int) -> DataFrame:
    """Each row twice: at its time (``kind`` ``value``) and when its timer fires (``timer``), as ``at_ms``."""
    now = epoch_ms(F.col(ts))
    value = F.struct(F.lit("value").alias("kind"), now.alias("at_ms"))
    timer = F.struct(F.lit("timer").alias("kind"), (now + delay_ms).alias("at_ms"))
    return df.select("*", F.explode(F.array(value, timer)).alias("__e")).select(*df.columns, "__e.kind", "__e.at_ms")
