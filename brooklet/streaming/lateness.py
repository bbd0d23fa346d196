"""Event-time windows that fire again for late rows."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from brooklet.functions.scalars import epoch_ms
from brooklet.streaming.intime import as_json, from_json_rows

Window = dict[str, Any]
_STEP_MS = 1_000


class LateWindows(StatefulProcessor):
    """The open windows of a key: count, sum and last row in time of each, kept past firing for late rows.

    Rows behind the watermark must reach the operator, so it runs in processing-time mode, which drops none. A key
    with open windows wakes up every second to see how far the watermark has come: to fire a window, and later to
    clean it up.
    """

    def __init__(self, size_ms: int, lateness_ms: int, names: list[str], orders: int):
        self.size, self.lateness, self.names, self.orders = size_ms, lateness_ms, names, orders

    def init(self, handle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "window string")

    def _pass(self, key: tuple, mark: int | None) -> Iterator[tuple]:
        """Fire and clean up what the watermark has passed."""
        if mark is None or not self.windows.exists():
            return
        for (start,), (text,) in sorted(self.windows.iterator()):
            end, window = start + self.size, json.loads(text)
            if end - 1 <= mark and not window["fired"]:
                window["fired"] = True
                if window["row"] is not None:
                    yield (*key, start, end, window["row"], window["n"], window["total"], "fire")
                self.windows.updateValue((start,), (json.dumps(window),))
            if end - 1 + self.lateness <= mark:
                self.windows.removeKey((start,))

    def _take(self, key: tuple, mark: int | None, ms: int, value: float | None, row: str) -> Iterator[tuple]:
        start = ms - ms % self.size
        end = start + self.size
        if mark is not None and end - 1 + self.lateness <= mark:
            yield (*key, start, end, row, None, None, "late")
            return
        kept = self.windows.getValue((start,)) if self.windows.exists() else None
        window = json.loads(kept[0]) if kept else {"n": 0, "total": None, "row": None, "fired": False}
        window["n"] += 1
        if value is not None:
            window["total"] = value + (window["total"] or 0.0)
        if mark is not None and end - 1 <= mark:
            yield (*key, start, end, row, window["n"], window["total"], "update")
        else:
            window["row"] = row
        self.windows.updateValue((start,), (json.dumps(window),))

    def _wake(self, timer_values) -> None:
        if self.windows.exists() and next(iter(self.windows.keys()), None) is not None:
            self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + _STEP_MS)

    def _mark(self, timer_values) -> int | None:
        """The watermark as of the replay, which is a millisecond behind the stream's."""
        mark = timer_values.getCurrentWatermarkInMs()
        return mark - 1 if mark > 0 else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, idle = self._mark(timerValues), not self.handle_has_timer()
        out = list(self._pass(key, mark))
        batch = pd.concat(list(rows), ignore_index=True).sort_values([f"o{i}" for i in range(self.orders)], kind="stable")
        for ms, value, row in batch[["row_ms", "value", "row"]].itertuples(index=False, name=None):
            out.extend(self._take(key, mark, int(ms), None if value is None or value != value else float(value), row))
        if idle:
            self._wake(timerValues)
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def handle_has_timer(self) -> bool:
        return next(iter(self.handle.listTimers()), None) is not None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = list(self._pass(key, self._mark(timerValues)))
        self._wake(timerValues)
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


def tumble_with_lateness_stream(df: DataFrame, ts: str, arrival: list[str], delay_ms: int, size_ms: int, lateness_ms: int, keys: list[str], value: str) -> DataFrame:
    """Streaming form of ``eventtime.tumble_with_lateness``; ``late`` rows are its side output.

    The watermark moves between micro-batches, not between rows. Like ``tag_late`` it has no last batch: start it with a
    processing-time trigger, not ``availableNow``. ``arrival`` are numbers.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")
    row = [*dict.fromkeys([*arrival, ts, value])]
    rows = timed.select(*keys, ts, epoch_ms(F.col(ts)).alias("row_ms"), F.col(value).cast("double").alias("value"), as_json(row).alias("row"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(arrival)])
    ddl = "w_start long, w_end long, row string, n long, total double, tag string"
    schema = T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(ddl).fields])
    processor = LateWindows(size_ms, lateness_ms, schema.fieldNames(), len(arrival))
    found = rows.groupBy(*keys).transformWithStateInPandas(processor, outputStructType=schema, outputMode="append", timeMode="ProcessingTime")
    opened = found.select(*keys, "w_start", "w_end", from_json_rows("row", timed, row), "n", "total", "tag")
    return opened.select(*keys, "w_start", "w_end", *[F.col(f"row.{c}") for c in row], "n", "total", "tag")
