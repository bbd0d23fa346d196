"""Final and running aggregates. Running forms emit one row per input row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.operators.ordered import Count, Max, Min, Ordered, Scan, Sum, position


def count_by(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def running(df: DataFrame, keys: list[str], order: list[str], **scans: Scan) -> DataFrame:
    """The input with one running column per scan."""
    return Ordered(df, keys, order).scan(**scans).result()


def running_reduce(df: DataFrame, keys: list[str], order: list[str], value: str, mark: str, label: str) -> DataFrame:
    """Running sum of ``value``. The first row of a key passes unchanged; from the second on ``mark`` is ``label``."""
    rows = Ordered(df, keys, order).scan(__seen=Count(), __total=Sum(value))
    marked = F.when(F.col("__seen") == 1, F.col(mark)).otherwise(F.lit(label))
    return rows.with_columns(**{mark: marked, value: F.col("__total")}).result().drop("__seen", "__total")


def _best(df: DataFrame, order: list[str], by: str, how: str, columns: list[str]) -> Column:
    """A struct whose largest (smallest) value is the best row; ties go to the earlier row."""
    sign = -1 if how == "max" else 1
    places = [(position(df, c) * sign).alias(f"o{i}") for i, c in enumerate(order)]
    return F.when(F.col(by).isNotNull(), F.struct(F.col(by).alias("by"), *places, F.struct(*columns).alias("row")))


def running_best(df: DataFrame, keys: list[str], order: list[str], by: str, how: str = "max", columns: list[str] | None = None) -> DataFrame:
    """For every row, ``columns`` of the row with the largest (smallest) ``by`` so far as ``best_*``."""
    columns = columns or [c for c in df.columns if c not in keys]
    scan = Max if how == "max" else Min
    rows = Ordered(df, keys, order).scan(__best=scan(_best(df, order, by, how, columns)))
    return rows.result().select(*df.columns, *[F.col("__best.row")[c].alias(f"best_{c}") for c in columns])


def final_best(df: DataFrame, keys: list[str], order: list[str], by: str, how: str = "max", columns: list[str] | None = None) -> DataFrame:
    """The last state of :func:`running_best`: one row per key, combined before the shuffle."""
    columns = columns or [c for c in df.columns if c not in keys]
    agg = F.max if how == "max" else F.min
    best = df.groupBy(*keys).agg(agg(_best(df, order, by, how, columns)).alias("__best"))
    return best.select(*keys, *[F.col("__best.row")[c].alias(c) for c in columns])


def reduce_then_best(df: DataFrame, keys: list[str], order: list[str], value: str, mark: str, label: str) -> DataFrame:
    """Running reduce, then running max over what it emits (``best_*`` columns), on one shuffle."""
    rows = Ordered(df, keys, order).scan(__seen=Count(), __total=Sum(value))
    marked = F.when(F.col("__seen") == 1, F.col(mark)).otherwise(F.lit(label))
    rows = rows.with_columns(**{mark: marked, value: F.col("__total")})
    rows = rows.scan(__best=Max(_best(rows.df, order, value, "max", [mark, value])))
    return rows.result().select(
        *df.columns, F.col("__best.row")[mark].alias(f"best_{mark}"), F.col("__best.row")[value].alias(f"best_{value}")
    )


def top_n(df: DataFrame, by: str, n: int, keys: list[str] | None = None, tie: list[str] | None = None) -> DataFrame:
    """The ``n`` largest rows with ``rank`` 1..n; equal values take separate ranks.

    Without keys Spark keeps n rows per task and merges them; with keys it limits each group before
    the shuffle, so neither form sorts or moves a whole group.
    """
    ordering = [F.col(by).desc(), *[F.col(t) for t in tie or []]]
    if not keys:
        best = df.where(F.col(by).isNotNull()).orderBy(*ordering).limit(n)
        return best.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*ordering)))
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.where(F.col(by).isNotNull()).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def running_distinct(df: DataFrame, keys: list[str], item: str, order: list[str]) -> DataFrame:
    """Exact running ``users`` (distinct items) and ``clicks`` (rows) per key, one row per input row."""
    first = Ordered(df, [*keys, item], order).scan(__before=Count(inclusive=False)).result()
    new = F.col("__before") == 0
    return Ordered(first, keys, order, probe=df).scan(users=Count(new), clicks=Count()).result().drop("__before")


def lag_report(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Consumer lag per (group, topic): ``lag`` and ``status``.

    ``ends(topic, partition, end_offset)``, ``committed(group, topic, partition, committed)``. Each group that
    committed anything is compared with all partitions of every topic. The status is ``lost`` if a partition
    is missing on either side (then there is no lag), else ``ok``.
    """
    # The groups are a short list, however many messages and offsets there are.
    groups = committed.agg(F.collect_set("group").alias("g")).scalar()
    wanted = ends.select("*", F.explode(groups).alias("group"))
    both = wanted.join(committed, ["group", "topic", "partition"], "full")
    lost = F.max(F.col("end_offset").isNull() | F.col("committed").isNull())
    per_group = both.groupBy("group", "topic").agg(lost.alias("__lost"), F.sum(F.col("end_offset") - F.col("committed")).alias("lag"))
    return per_group.select(
        "group",
        "topic",
        F.when(~F.col("__lost"), F.col("lag")).alias("lag"),
        F.when(F.col("__lost"), F.lit("lost")).otherwise(F.lit("ok")).alias("status"),
    )
