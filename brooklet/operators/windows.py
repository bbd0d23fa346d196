"""Time, count and row windows. Time windows are ``[start, start + size)``, aligned to the epoch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Count, History, Last, Ordered, Scan


def window_start(ts: Column, size_ms: int) -> Column:
    """Start of the window a timestamp falls in, in epoch milliseconds."""
    ms = epoch_ms(ts)
    return ms - F.pmod(ms, F.lit(size_ms))


def with_window(df: DataFrame, ts: str, size_ms: int) -> DataFrame:
    """Add ``w_start`` and ``w_end`` in epoch milliseconds."""
    start = window_start(F.col(ts), size_ms)
    return df.withColumns({"w_start": start, "w_end": start + size_ms})


def tumble(df: DataFrame, ts: str, size: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Tumbling window aggregate with ``window_start`` and ``window_end`` (also works on a stream)."""
    grouped = df.groupBy(F.window(ts, size).alias("__w"), *keys).agg(*aggs)
    values = [c for c in grouped.columns if c not in ("__w", *keys)]
    return grouped.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *values)


def count_slide(df: DataFrame, keys: list[str], order: list[str], size: int, slide: int, *aggs: Column) -> DataFrame:
    """Count window: fires at every ``slide``-th row of a key over its last ``size`` rows (``fire`` = row number).

    Rows are numbered, then each row is sent to the firings it belongs to and those are aggregated, so
    the groups have at most ``size`` rows however many rows the key has.
    """
    rows = Ordered(df, keys, order).scan(__rn=Count()).result()
    first = F.ceil(F.col("__rn") / slide) * slide
    fires = F.filter(F.sequence(first, F.col("__rn") + size - 1), lambda f: f % slide == 0)
    sent = rows.where(first < F.col("__rn") + size).withColumn("fire", F.explode(fires))
    return sent.groupBy(*keys, "fire").agg(F.max("__rn").alias("__last"), *aggs).where(F.col("__last") == F.col("fire")).drop("__last")


def count_slide_partials(
    df: DataFrame, keys: list[str], order: list[str], size: int, slide: int, partial: dict[str, Column], merge: dict[str, Column]
) -> DataFrame:
    """``count_slide`` where ``slide`` divides ``size``, by partial aggregates: ``partial`` over the rows of a slide, then
    ``merge`` over the ``size / slide`` partials of a firing. A partial, not a row, is sent to each firing."""
    if size % slide:
        raise ValueError("slide must divide size")
    rows = Ordered(df, keys, order).scan(__rn=Count()).result()
    block = F.ceil(F.col("__rn") / slide).cast("long")
    parts = rows.withColumn("__block", block).groupBy(*keys, "__block").agg(F.count(F.lit(1)).alias("__n"), *[c.alias(n) for n, c in partial.items()])
    fires = F.explode(F.sequence(F.col("__block"), F.col("__block") + size // slide - 1))
    sent = parts.withColumn("__fire", fires)
    full = F.max(F.when(F.col("__block") == F.col("__fire"), F.col("__n"))) == slide
    merged = sent.groupBy(*keys, "__fire").agg(full.alias("__full"), *[c.alias(n) for n, c in merge.items()]).where("__full")
    return merged.select(*keys, (F.col("__fire") * slide).alias("fire"), *merge)


def over_rows(df: DataFrame, keys: list[str], order: list[str], preceding: int, value: str) -> DataFrame:
    """Count and mean of ``value`` over the current and the ``preceding`` rows: ``n`` and ``mean``."""
    rows = Ordered(df, keys, order)
    source = F.struct(F.col(value).alias("v"))
    frame = [source]
    for i in range(1, preceding + 1):
        rows = rows.scan(**{f"__b{i}": Last(source)})
        source = F.col(f"__b{i}")
        frame.append(source)
    count = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in frame[1:]), F.lit(1))
    filled = sum((F.when(c["v"].isNotNull(), 1).otherwise(0) for c in frame), F.lit(0))
    total = sum((F.coalesce(c["v"], F.lit(0.0)) for c in frame), F.lit(0.0))
    return rows.with_columns(n=count.cast("long"), mean=F.try_divide(total, filled)).result(*df.columns, "n", "mean")


def cumulative(df: DataFrame, ts: str, size_ms: int, keys: list[str]) -> DataFrame:
    """Per key and window the rows of the window (``n``) and of all windows so far (``total``).

    The running sum sees one row per key and window, so its size depends on time, not on traffic.
    """
    per = with_window(df, ts, size_ms).groupBy(*keys, "w_start", "w_end").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("w_start").rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumn("total", F.sum("n").over(w))


def per_row_total(df: DataFrame, ts: str, size_ms: int, keys: list[str], order: list[str], total: Scan | None = None) -> DataFrame:
    """Each row with its window and the key's running total over all windows (a row count by default)."""
    return Ordered(with_window(df, ts, size_ms), keys, order).scan(total=total or Count()).result()


def stuck_total(df: DataFrame, ts: str, size_ms: int, keys: list[str], order: list[str]) -> DataFrame:
    """A counter that is read once per window and written back as read + 1: it counts windows, not rows."""
    rows = Ordered(with_window(df, ts, size_ms), keys, order).scan(__before=Last("w_start"))
    opens = F.col("__before").isNull() | (F.col("__before") != F.col("w_start"))
    return rows.scan(total=Count(opens)).result().drop("__before")


def value_list(df: DataFrame, ts: str, size_ms: int, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per key and window the list of all values of the key up to the end of the window (``history``)."""
    item = F.struct(F.struct(*order).alias("o"), F.col(value).alias("v"))
    per = with_window(df, ts, size_ms).groupBy(*keys, "w_start", "w_end").agg(F.array_sort(F.collect_list(item)).alias("__items"))
    per = per.select(*keys, "w_start", "w_end", F.transform("__items", lambda x: x["v"]).alias("__values"))
    lists = Ordered(per, keys, ["w_start"]).scan(history=History("__values")).result()
    return lists.withColumn("history", F.flatten("history")).drop("__values")


def up_down(df: DataFrame, ts: str, size_ms: int, keys: list[str], value: str, threshold: float) -> DataFrame:
    """Cumulative rows above (``up``) and not above (``down``) a threshold per window.

    The first window of a key only sets the counters up: its rows are not counted and it emits nothing.
    """
    above = F.col(value) > threshold
    per = with_window(df, ts, size_ms).groupBy(*keys, "w_start", "w_end").agg(
        F.count(F.when(above, 1)).alias("__up"), F.count(F.when(~above, 1)).alias("__down")
    )
    w = Window.partitionBy(*keys).orderBy("w_start")
    later = per.withColumn("__i", F.row_number().over(w)).where(F.col("__i") > 1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return later.select(*keys, "w_start", "w_end", F.sum("__up").over(upto).alias("up"), F.sum("__down").over(upto).alias("down"))


def labelled_sum(df: DataFrame, ts: str, size_ms: int, key: str, value: Column) -> DataFrame:
    """Per window ``key,last arrival,sum`` as one string, next to its parts."""
    per = with_window(df, ts, size_ms).groupBy(key, "w_start", "w_end").agg(
        F.max(epoch_ms(F.col(ts))).alias("last_ms"), F.sum(value).alias("total")
    )
    return per.withColumn("text", F.concat_ws(",", F.col(key).cast("string"), F.col("last_ms").cast("string"), F.col("total").cast("string")))


