"""Keyed stream operators that see their rows in event-time order, whatever order they arrive in.

Rows ahead of the watermark wait in map state by their millisecond. Once the watermark has passed a millisecond no
more rows of it can come, so they are taken out in order and handed to the operator; then its own timers that
are due before the watermark act. A key has one timer, at the next moment at which anything can happen; it is moved,
not multiplied. A key whose operator is back at its start, with nothing waiting, leaves the store.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

State = dict[str, Any]

# Rows are kept as JSON with whole microseconds.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class InTimeOrder(StatefulProcessor):
    """Subclasses say what a row does (``take``) and what happens when time passes (``pass_time``, ``due``)."""

    def __init__(self, names: list[str], orders: int):
        self.names, self.orders = names, orders

    def start(self) -> State:
        return {}

    def take(self, state: State, ms: int, values: dict[str, Any]) -> list[tuple]:
        raise NotImplementedError

    def pass_time(self, state: State, mark: int) -> list[tuple]:
        """What is due before ``mark``; all rows before it have been taken."""
        return []

    def due(self, state: State) -> int | None:
        return None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ms long", "rows string")
        self.state = handle.getValueState("state", "value string")
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, list[str]] = {}
        for batch in rows:
            for ms, packed in zip((batch["row_us"] // 1000).tolist(), batch["packed"]):
                fresh.setdefault(ms, []).append(packed)
        armed = self.alarm.get()[0] if self.alarm.exists() else None
        yield from self._run(key, fresh, timerValues.getCurrentWatermarkInMs(), armed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._run(key, {}, timerValues.getCurrentWatermarkInMs(), None)

    def _run(self, key: tuple, fresh: dict[int, list[str]], mark: int, armed: int | None) -> Iterator[pd.DataFrame]:
        ready, first = [], None
        held = {ms: text for (ms,), (text,) in self.waiting.iterator()} if self.waiting.exists() else {}
        for ms in sorted(held.keys() | fresh.keys()):
            if mark > 0 and ms < mark:
                ready += json.loads(held[ms]) if ms in held else []
                ready += fresh.get(ms, [])
                if ms in held:
                    self.waiting.removeKey((ms,))
                continue
            first = ms if first is None else first
            if ms in fresh:
                self.waiting.updateValue((ms,), (json.dumps([*json.loads(held.get(ms, "[]")), *fresh[ms]]),))
        state = json.loads(self.state.get()[0]) if self.state.exists() else self.start()
        out: list[tuple] = []
        for row in sorted(map(json.loads, ready), key=self._place):
            out.extend(self.take(state, row["us"] // 1000, row))
        if mark > 0:
            out.extend(self.pass_time(state, mark))
        if state == self.start():
            self.state.clear()
        else:
            self.state.update((json.dumps(state),))
        moments = [m for m in (first, self.due(state)) if m is not None]
        self._arm(min(moments) + 1 if moments else None, armed)
        if out:
            yield pd.DataFrame([key + o for o in out], columns=self.names)

    def _place(self, row: dict) -> tuple:
        return (row["us"], *((row.get(f"o{i}") is not None, row.get(f"o{i}")) for i in range(self.orders)))

    def _arm(self, at: int | None, armed: int | None) -> None:
        if at == armed:
            return
        if armed is not None:
            self.handle.deleteTimer(armed)
        if at is None:
            self.alarm.clear()
        else:
            self.alarm.update((at,))
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def _plain(column: Column, kind: T.DataType) -> Column:
    """Numbers and texts as JSON keeps them: moments as microseconds, no NaN."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def packed_rows(df: DataFrame, keys: list[str], order: list[str], ts: str, delay_ms: int, values: dict[str, Column]) -> DataFrame:
    """``keys``, the event time ``ts``, ``row_us`` and the row as JSON: its time ``us``, order columns ``o0..``, ``values``."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")
    us = F.unix_micros(F.col(ts))
    known = timed.select(*[c.alias(n) for n, c in values.items()]).schema
    fields = [_plain(timed[c], timed.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(order)]
    fields += [_plain(c, known[n].dataType).alias(n) for n, c in values.items()]
    return timed.where(us.isNotNull()).select(*keys, ts, us.alias("row_us"), F.to_json(F.struct(us.alias("us"), *fields)).alias("packed"))


def run_in_time_order(rows: DataFrame, keys: list[str], processor: InTimeOrder, schema: T.StructType) -> DataFrame:
    return rows.groupBy(*keys).transformWithStateInPandas(processor, outputStructType=schema, outputMode="append", timeMode="EventTime")


def keyed_schema(df: DataFrame, keys: list[str], ddl: str) -> T.StructType:
    return T.StructType([*(df.schema[k] for k in keys), *T.StructType.fromDDL(ddl).fields])


def as_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), JSON_TIME)


def from_json_rows(name: str, df: DataFrame, columns: list[str]) -> Column:
    """A row written by ``as_json`` as a struct of ``columns`` again, under its name."""
    return F.from_json(F.col(name), T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns]), JSON_TIME).alias(name)
