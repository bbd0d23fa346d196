"""Stream-stream joins inside tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_join_stream(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size: str, delay_ms: int, how: str = "inner"
) -> DataFrame:
    """Streaming form of ``joins.window_join``. Both watermarks are needed: they bound the state and tell
    when an unmatched left row may leave with nulls. Column names must differ except for the keys."""

    def windowed(df: DataFrame, ts: str) -> DataFrame:
        timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")
        # Only the window stays an event-time column: a stream may have one.
        return timed.withColumn("w", F.window(ts, size)).withColumn(ts, F.timestamp_micros(F.unix_micros(ts)))

    joined = windowed(left, left_ts).join(windowed(right, right_ts), [*keys, "w"], how)
    return joined.withColumns({"w_start": F.unix_millis("w.start"), "w_end": F.unix_millis("w.end")}).drop("w")


def followed_by_stream(
    first: DataFrame, second: DataFrame, keys: list[str], first_ts: str, second_ts: str, within: str, delay_ms: int
) -> DataFrame:
    """Each ``first`` row with every ``second`` row of its key later by less than ``within``, or with nulls once that
    time has passed: a left interval join. It gives all followers, and none at the very same time. For the first
    follower only, equal times included, use ``streaming.patterns.match_stream``, which equals the batch form."""
    a = first.withColumn(first_ts, F.col(first_ts).cast("timestamp")).withWatermark(first_ts, f"{delay_ms} milliseconds")
    b = second.withColumn(second_ts, F.col(second_ts).cast("timestamp")).withWatermark(second_ts, f"{delay_ms} milliseconds")
    b = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    near = (b[second_ts] > a[first_ts]) & (b[second_ts] < a[first_ts] + F.expr(f"INTERVAL {within}"))
    for k in keys:
        near = near & (a[k] == b[f"__{k}"])
    return a.join(b, near, "left").drop(*[f"__{k}" for k in keys])
