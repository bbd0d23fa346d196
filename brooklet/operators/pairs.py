"""Two-stream sums whose state can be written as running expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Count, Last, Max, Min, Next, Ordered, Sum, position
from brooklet.session import saved


def _both(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], ts: str, value: str) -> DataFrame:
    sides = [df.select(*keys, *order, epoch_ms(F.col(ts)).alias("at_ms"), F.lit(src).alias("src"), F.col(value).cast("double").alias("n"))
             for src, df in (("left", left), ("right", right))]
    return sides[0].unionByName(sides[1])


def pair_sum_sticky(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], ts: str, value: str) -> DataFrame:
    """Never clears: the side seen first keeps replacing its value, every row of the other side emits a sum.

    Result: keys, order, ``at_ms``, ``total``.
    """
    rows = _both(left, right, keys, order, ts, value)
    place = F.struct(*[position(rows, c).alias(f"o{i}") for i, c in enumerate(order)], F.col("src"))
    scanned = Ordered(rows, keys, order).scan(__first=Min(place))
    holds = F.col("src") == F.col("__first.src")
    scanned = scanned.scan(__stored=Last("n", where=holds))
    return scanned.result().where(~holds).select(*keys, *order, "at_ms", (F.col("n") + F.col("__stored")).alias("total"))


def pair_sum_accumulate(
    left: DataFrame, right: DataFrame, keys: list[str], order: list[str], ts: str, value: str, timeout_ms: int
) -> DataFrame:
    """Repeats on one side are added up; the other side's row emits the sum and clears. A timer gives the
    stored value away but does not clear it. Result: keys, ``at_ms``, ``kind`` (``sum``/``left``/``right``), ``total``.

    Whether a row stores or matches needs no state machine: after two rows of one side in a row (or the
    first row) something is stored, and from there on alternating rows match and store in turn.
    """
    rows = Ordered(_both(left, right, keys, order, ts, value), keys, order)
    rows = rows.scan(__prev=Last("src"), __rn=Count())
    repeats = F.col("__prev").isNull() | (F.col("__prev") == F.col("src"))
    rows = rows.scan(__sync=Max(F.when(repeats, F.col("__rn"))))
    matches = (F.col("__rn") - F.col("__sync")) % 2 == 1
    rows = rows.with_columns(__match=matches)
    rows = rows.scan(
        __cum=Sum(F.when(F.col("__match"), F.lit(0.0)).otherwise(F.col("n"))),
        __then=Next(F.struct("__match", "at_ms")),
    )
    rows = rows.scan(__base=Last("__cum", where=F.col("__match")))
    held = F.col("__cum") - F.coalesce(F.col("__base"), F.lit(0.0))
    # Used three times below, so it is written once.
    state = saved(rows.with_columns(__held=held).result(), "pair-state")

    sums = state.where("__match").select(*keys, "at_ms", F.lit("sum").alias("kind"), (F.col("n") + F.col("__held")).alias("total"))

    due = F.col("at_ms") + timeout_ms
    deleted = F.coalesce(F.col("__then.__match") & (F.col("__then.at_ms") < due), F.lit(False))
    timers = (
        state.where(~F.col("__match"))
        .groupBy(*keys, due.alias("at_ms"))
        .agg(F.max_by(deleted, F.struct(*order)).alias("__deleted"))
        .where(~F.col("__deleted"))
        .select(*keys, "at_ms", F.lit(0).alias("__kind"))
    )
    stored = F.struct(F.when(~F.col("__match"), F.col("src")).alias("src"), F.col("__held").alias("held"))
    marks = state.select(*keys, "at_ms", F.lit(1).alias("__kind"), *order, stored.alias("__state"))
    line = marks.unionByName(timers, allowMissingColumns=True)
    at = Ordered(line, keys, ["at_ms", "__kind", *order]).scan(__now=Last("__state", where=F.col("__kind") == 1))
    given = at.result().where((F.col("__kind") == 0) & F.col("__now.src").isNotNull())
    return sums.unionByName(given.select(*keys, "at_ms", F.col("__now.src").alias("kind"), F.col("__now.held").alias("total")))
