"""Replay watermarks and late data.

A batch replay takes an arrival order and gives every row the watermark that held before it arrived:
``max(event time of earlier rows) - delay - 1 ms``. A window ``[s, e)`` fires once the watermark reaches
``e - 1``; a row is late for it when ``e - 1 + lateness <= watermark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Count, Max, Next, Ordered, Sum
from brooklet.operators.windows import with_window


def _watermarked(df: DataFrame, ts: str, arrival: list[str], delay_ms: int, probe: DataFrame | None = None, seen_ms: int | None = None) -> Ordered:
    rows = Ordered(df, [], arrival, probe=probe).scan(__seen=Max(epoch_ms(F.col(ts)), inclusive=False))
    if seen_ms is not None:
        rows = rows.with_columns(__seen=F.greatest(F.col("__seen"), F.lit(seen_ms)))
    return rows.with_columns(watermark=F.col("__seen") - delay_ms - 1)


def replay_watermark(
    df: DataFrame, ts: str, arrival: list[str], delay_ms: int = 0, probe: DataFrame | None = None, seen_ms: int | None = None
) -> DataFrame:
    """Add ``watermark`` in epoch milliseconds, null before the first row. Delay 0: monotonous time stamps.
    ``seen_ms`` is the largest event time before ``df``, where the rows go on a sequence."""
    return _watermarked(df, ts, arrival, delay_ms, probe, seen_ms).result().drop("__seen")


def with_stream_watermark(df: DataFrame, ts: str, delay_ms: int = 0) -> DataFrame:
    """Streaming form: Spark's own watermark. It needs a time-zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")


def split_late(df: DataFrame, ts: str, arrival: list[str], delay_ms: int) -> DataFrame:
    """Tag each row ``late`` if its time is behind the watermark, else ``normal``."""
    rows = replay_watermark(df, ts, arrival, delay_ms)
    behind = F.coalesce(epoch_ms(F.col(ts)) < F.col("watermark"), F.lit(False))
    return rows.withColumn("tag", F.when(behind, F.lit("late")).otherwise(F.lit("normal")))


def _late_for_window(lateness_ms: int = 0) -> Column:
    return F.coalesce(F.col("w_end") - 1 + lateness_ms <= F.col("watermark"), F.lit(False))


def split_window_late(
    df: DataFrame, ts: str, arrival: list[str], delay_ms: int, size_ms: int, probe: DataFrame | None = None, seen_ms: int | None = None
) -> DataFrame:
    """Tag each row ``late`` if its window has already fired, else ``normal``; adds ``w_start``, ``w_end``."""
    rows = with_window(replay_watermark(df, ts, arrival, delay_ms, probe, seen_ms), ts, size_ms)
    return rows.withColumn("tag", F.when(_late_for_window(), F.lit("late")).otherwise(F.lit("normal")))


def tumble_with_lateness(
    df: DataFrame,
    ts: str,
    arrival: list[str],
    delay_ms: int,
    size_ms: int,
    lateness_ms: int,
    keys: list[str],
    value: str,
) -> DataFrame:
    """Every firing of every window, plus the rows that came too late.

    ``tag`` is ``fire`` (first result, at its last row on time), ``update`` (a late row inside the allowed
    lateness fires the window again) or ``late`` (dropped by the window; ``n`` and ``total`` are null).
    ``n`` and ``total`` are the count and sum of the window at that moment.
    """
    columns = dict.fromkeys([*keys, "w_start", "w_end", *arrival, ts, value])
    rows = split_window_late(df, ts, arrival, delay_ms, size_ms).select(
        *columns, (F.col("tag") == "late").alias("__late"), _late_for_window(lateness_ms).alias("__gone")
    )
    # The watermark only grows: in arrival order a window has rows on time, then late ones, then lost ones.
    kept = F.when(~F.col("__gone"), F.col(value))
    scanned = Ordered(rows, [*keys, "w_start"], arrival, probe=with_window(df, ts, size_ms)).scan(
        n=Count(~F.col("__gone")), total=Sum(kept), __next=Next("__late")
    )
    fires = scanned.result().where(F.col("__late") | F.coalesce("__next", F.lit(True)))
    tag = F.when(F.col("__gone"), F.lit("late")).when(F.col("__late"), F.lit("update")).otherwise(F.lit("fire"))
    return fires.select(
        *columns,
        F.when(~F.col("__gone"), F.col("n")).alias("n"),
        F.when(~F.col("__gone"), F.col("total")).alias("total"),
        tag.alias("tag"),
    )


def split_late_at_fire(df: DataFrame, ts: str, arrival: list[str], delay_ms: int, size_ms: int) -> DataFrame:
    """Quirk form: a row is judged when its window fires, against the watermark of that moment.

    The window fires at ``watermark >= end - 1``, so a row is only ``normal`` if it has the very last
    millisecond of its window and the watermark stopped exactly there. Rows whose window had already
    fired are dropped, as the window itself drops them.
    """
    rows = _watermarked(df, ts, arrival, delay_ms)
    rows = rows.with_columns(__after=F.greatest(F.col("__seen"), epoch_ms(F.col(ts))) - delay_ms - 1)
    all_rows = with_window(rows.result().drop("__seen"), ts, size_ms)
    in_time = all_rows.where(~_late_for_window()).drop("__after")
    stops = all_rows.where((F.col("__after") + 1) % size_ms == 0).select((F.col("__after") + 1).alias("__stop")).distinct()
    joined = in_time.join(stops, in_time["w_end"] == stops["__stop"], "left")
    exact = (epoch_ms(F.col(ts)) == F.col("w_end") - 1) & F.col("__stop").isNotNull()
    return joined.withColumn("tag", F.when(exact, F.lit("normal")).otherwise(F.lit("late"))).drop("__stop")
