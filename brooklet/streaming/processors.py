"""Streaming forms of the keyed operators, on ``transformWithState`` (RocksDB state store).

Machines, segments, silences and previous values take rows in event-time order (``intime``). In the others arrival
order decides, as in the replay forms; inside a micro-batch rows are sorted by time and id.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from brooklet.functions.bloom import Bloom
from brooklet.functions.scalars import epoch_ms
from brooklet.operators.machines import Machine
from brooklet.streaming.intime import InTimeOrder, State, as_json, from_json_rows, keyed_schema, packed_rows, run_in_time_order


def _sorted(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable")


def _plain(value: Any) -> Any:
    if value is None or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


class MachineProcessor(InTimeOrder):
    """Runs a :class:`Machine`; its state is one JSON value per key."""

    def __init__(self, machine: Machine, names: list[str], orders: int):
        super().__init__(names, orders)
        self.machine = machine

    def start(self) -> State:
        return self.machine.start()

    def take(self, state, ms, values):
        out = self.machine.advance(state, ms, self.machine.timer_first)
        before = {name: state.pop(f"last {source}", None) for name, source in self.machine.previous.items()}
        out += self.machine.row(state, ms, *[before[n] if n in before else values.get(n) for n in self.machine.needs])
        state.update({f"last {source}": values.get(source) for source in self.machine.previous.values()})
        return out

    def pass_time(self, state, mark):
        return self.machine.advance(state, mark, False)

    def due(self, state):
        return self.machine.due(state)


def run_machine(df: DataFrame, keys: list[str], order: list[str], ts: str, machine: Machine, delay_ms: int = 0) -> DataFrame:
    """Streaming form of ``machines.replay``. Rows are taken in the order of ``ts`` and ``order``, once the watermark
    has passed them, and timers fire once it has passed them. A machine that looks at the previous value of a key
    keeps that value for good."""
    sources = [c for c in dict.fromkeys([*machine.needs, *machine.previous.values()]) if c not in machine.previous]
    extra = [c for c in order if c not in (*keys, "row_ms", ts)]
    rows = packed_rows(df, keys, extra, ts, delay_ms, {c: F.col(c) for c in sources})
    schema = keyed_schema(df, keys, machine.emits)
    return run_in_time_order(rows, keys, MachineProcessor(machine, schema.fieldNames(), len(extra)), schema)


class Segments(InTimeOrder):
    """Rows between two delimiters: appended to list state, drained at the delimiter."""

    def init(self, handle):
        super().init(handle)
        self.body = handle.getListState("body", "v string")

    def take(self, state, ms, values):
        if "delimiter" not in values:
            return []
        if not values["delimiter"]:
            self.body.appendValue((values.get("v"),))
            return []
        body = [v for (v,) in self.body.get()] if self.body.exists() else []
        self.body.clear()
        number = state.get("segment", 0)
        state["segment"] = number + 1
        return [(number, len(body), " ".join(v for v in body if v is not None))] if body else []


def delimited_segments_stream(df: DataFrame, keys: list[str], order: list[str], ts: str, value: str, delimiter: Column, delay_ms: int = 0) -> DataFrame:
    """Streaming form of ``stateful.delimited_segments``: a segment comes out when the delimiter that ends it does."""
    rows = packed_rows(df, keys, order, ts, delay_ms, {"v": F.col(value).cast("string"), "delimiter": delimiter})
    schema = keyed_schema(df, keys, "segment long, n long, text string")
    return run_in_time_order(rows, keys, Segments(schema.fieldNames(), len(order)), schema)


class Inactivity(InTimeOrder):
    """The running count of a key, and the one timer that every row moves."""

    def __init__(self, idle_ms: int, names: list[str], orders: int):
        super().__init__(names, orders)
        self.idle = idle_ms

    def start(self) -> State:
        return {"total": 0, "last": None, "row": None}

    def _fire(self, state: State) -> list[tuple]:
        out = [(state["row"], state["total"], state["last"] + self.idle)]
        state["last"] = state["row"] = None
        return out

    def take(self, state, ms, values):
        out = self._fire(state) if state["last"] is not None and ms - state["last"] >= self.idle else []
        state.update(total=state["total"] + 1, last=ms, row=values["row"])
        return out

    def pass_time(self, state, mark):
        return self._fire(state) if state["last"] is not None and state["last"] + self.idle < mark else []

    def due(self, state):
        return None if state["last"] is None else state["last"] + self.idle


def inactivity_stream(df: DataFrame, keys: list[str], order: list[str], ts: str, idle_ms: int, delay_ms: int = 0) -> DataFrame:
    """Streaming form of ``stateful.inactivity``: the row after which a key was silent, its ``total``, ``fired_ms``."""
    rows = packed_rows(df, keys, order, ts, delay_ms, {"row": as_json([c for c in df.columns if c not in keys])})
    schema = keyed_schema(df, keys, "row string, total long, fired_ms long")
    found = run_in_time_order(rows, keys, Inactivity(idle_ms, schema.fieldNames(), len(order)), schema)
    rest = [c for c in df.columns if c not in keys]
    opened = found.select(*keys, from_json_rows("row", df, rest), "total", "fired_ms")
    return opened.select(*[F.col(c) if c in keys else F.col(f"row.{c}") for c in df.columns], "total", "fired_ms")


class Previous(InTimeOrder):
    """Every row with the key's previous value."""

    def take(self, state, ms, values):
        before = state.get("value")
        state["value"] = values.get("v")
        return [(values["row"], before)]


def with_previous_stream(df: DataFrame, keys: list[str], order: list[str], ts: str, value: str, name: str, delay_ms: int = 0) -> DataFrame:
    """Every row with ``name``, the text ``value`` of the key's row before it in the order of ``ts`` and ``order``."""
    rest = [c for c in df.columns if c not in keys]
    rows = packed_rows(df, keys, order, ts, delay_ms, {"v": F.col(value).cast("string"), "row": as_json(rest)})
    schema = keyed_schema(df, keys, "row string, previous string")
    found = run_in_time_order(rows, keys, Previous(schema.fieldNames(), len(order)), schema)
    opened = found.select(*keys, from_json_rows("row", df, rest), F.col("previous").cast(df.schema[value].dataType).alias(name))
    return opened.select(*[F.col(c) if c in keys else F.col(f"row.{c}") for c in df.columns], name)


class LateTagger(StatefulProcessor):
    """Tags rows by the stream's watermark instead of dropping the late ones."""

    def __init__(self, names: list[str], size_ms: int | None):
        self.names, self.size = names, size_ms

    def init(self, handle):
        pass

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            end = batch["row_ms"] if self.size is None else batch["row_ms"] - batch["row_ms"] % self.size + self.size
            # The replay's watermark is one millisecond behind the stream's.
            limit = end < mark - 1 if self.size is None else end <= mark
            tag = limit.map({True: "late", False: "normal"}) if mark >= 0 else "normal"
            yield batch.assign(tag=tag)[self.names]

    def close(self):
        pass


def tag_late(df: DataFrame, ts: str, delay_ms: int, keys: list[str], size_ms: int | None = None) -> DataFrame:
    """Side output for late rows of a stream: ``tag`` is ``late`` behind the watermark (``size_ms``: behind the
    end of the row's window), else ``normal``. Processing-time mode keeps the rows Spark would drop; such a
    query has no last batch, so start it with a processing-time trigger, not ``availableNow``."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")
    rows = timed.withColumn("row_ms", epoch_ms(F.col(ts)))
    schema = T.StructType([*timed.schema.fields, T.StructField("tag", T.StringType())])
    return rows.groupBy(*keys).transformWithStateInPandas(
        LateTagger(schema.fieldNames(), size_ms), outputStructType=schema, outputMode="append", timeMode="ProcessingTime"
    )


class DistinctCounter(StatefulProcessor):
    """Exact distinct items (map state) and rows per key, one emission per row."""

    def __init__(self, item: str, order: list[str], names: list[str]):
        self.item, self.order, self.names = item, order, names

    def init(self, handle):
        self.items = handle.getMapState("items", "item string", "seen int")
        self.totals = handle.getValueState("totals", "users long, clicks long")

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, self.order)
        users, clicks = self.totals.get() if self.totals.exists() else (0, 0)
        counted = []
        for item in ("null" if (v := _plain(x)) is None else f"={v}" for x in batch[self.item]):
            if not self.items.containsKey((item,)):
                self.items.updateValue((item,), (1,))
                users += 1
            clicks += 1
            counted.append((users, clicks))
        self.totals.update((users, clicks))
        yield batch.assign(users=[u for u, _ in counted], clicks=[c for _, c in counted])[self.names]

    def close(self):
        pass


class BloomCounter(DistinctCounter):
    """The same with a Bloom filter in pages of map state: state does not grow beyond the filter's size."""

    def __init__(self, item: str, order: list[str], names: list[str], bloom: Bloom):
        super().__init__(item, order, names)
        self.bloom = bloom

    def init(self, handle):
        self.pages = handle.getMapState("pages", "page int", "bits binary")
        self.totals = handle.getValueState("totals", "users long, clicks long")

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, self.order)
        users, clicks = self.totals.get() if self.totals.exists() else (0, 0)
        touched, changed, counted = {}, set(), []
        for item in ("null" if (v := _plain(x)) is None else f"={v}" for x in batch[self.item]):
            page, bits = self.bloom.place(item)
            if page not in touched:
                kept = self.pages.getValue((page,))
                touched[page] = bytearray(kept[0]) if kept else self.bloom.empty()
            if self.bloom.add(touched[page], bits):
                users += 1
                changed.add(page)
            clicks += 1
            counted.append((users, clicks))
        for page in changed:
            self.pages.updateValue((page,), (bytes(touched[page]),))
        self.totals.update((users, clicks))
        yield batch.assign(users=[u for u, _ in counted], clicks=[c for _, c in counted])[self.names]


def running_distinct_stream(df: DataFrame, keys: list[str], item: str, order: list[str], bloom: Bloom | None = None) -> DataFrame:
    """Streaming form of ``aggregates.running_distinct``. Exact, with all items of a key in state; with ``bloom`` in
    state of fixed size, ``users`` too low by the filter's error at most while its number of items holds."""
    counts = [T.StructField("users", T.LongType()), T.StructField("clicks", T.LongType())]
    schema = T.StructType([*df.schema.fields, *counts])
    names = schema.fieldNames()
    counter = DistinctCounter(item, order, names) if bloom is None else BloomCounter(item, order, names, bloom)
    return df.groupBy(*keys).transformWithStateInPandas(counter, outputStructType=schema, outputMode="append", timeMode="None")


class CountRing(StatefulProcessor):
    """Sliding count windows: one partial aggregate per slide in map state, the latest ``size / slide`` of them.

    A firing merges partials, not rows, and the state has as many numbers however long the window is.
    """

    def __init__(self, value: str, size: int, slide: int, order: list[str], names: list[str]):
        self.value, self.size, self.slide, self.order, self.names = value, size, slide, order, names

    def init(self, handle):
        self.seen = handle.getValueState("seen", "n long")
        self.ring = handle.getMapState("ring", "slot long", "n long, total double, low double, high double")

    def _add(self, part: tuple, value: float | None) -> tuple:
        n, total, low, high = part
        if value is None:
            return part
        return (n + 1, (total or 0.0) + value, value if low is None else min(low, value), value if high is None else max(high, value))

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, self.order)
        seen, slots = self.seen.get()[0] if self.seen.exists() else 0, self.size // self.slide
        parts = {slot: part for (slot,), part in self.ring.iterator()} if self.ring.exists() else {}
        out, dirty = [], set()
        for value in (_plain(v) for v in batch[self.value]):
            slot = seen // self.slide % slots
            if seen % self.slide == 0:
                parts[slot] = (0, None, None, None)
            parts[slot] = self._add(parts[slot], value)
            dirty.add(slot)
            seen += 1
            if seen % self.slide == 0:
                filled = [p for p in parts.values() if p[0]]
                total = sum(p[1] for p in filled) if filled else None
                out.append((*key, seen, sum(p[0] for p in filled), total, min((p[2] for p in filled), default=None), max((p[3] for p in filled), default=None)))
        for slot in dirty:
            self.ring.updateValue((slot,), parts[slot])
        self.seen.update((seen,))
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def close(self):
        pass


def count_slide_stream(df: DataFrame, keys: list[str], order: list[str], size: int, slide: int, value: str) -> DataFrame:
    """Streaming form of ``windows.count_slide`` where ``slide`` divides ``size``: ``fire``, and ``n``, ``total``, ``low`` and
    ``high`` of the values of the key's last ``size`` rows."""
    if size % slide:
        raise ValueError("slide must divide size")
    rows = df.select(*dict.fromkeys([*keys, *order]), F.col(value).cast("double").alias("slid"))
    schema = keyed_schema(df, keys, "fire long, n long, total double, low double, high double")
    return rows.groupBy(*keys).transformWithStateInPandas(
        CountRing("slid", size, slide, order, schema.fieldNames()), outputStructType=schema, outputMode="append", timeMode="None"
    )


class LastRows(StatefulProcessor):
    """Count and mean of a value over the current and the preceding rows (list state)."""

    def __init__(self, value: str, preceding: int, order: list[str], names: list[str]):
        self.value, self.preceding, self.order, self.names = value, preceding, order, names

    def init(self, handle):
        self.kept = handle.getListState("kept", "v double")

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, self.order)
        held = [r[0] for r in self.kept.get()] if self.kept.exists() else []
        values = held + [_plain(v) for v in batch[self.value]]
        frames = [values[max(0, i - self.preceding) : i + 1] for i in range(len(held), len(values))]
        filled = [[v for v in f if v is not None] for f in frames]
        keep = values[max(0, len(values) - self.preceding) :]
        if keep:
            self.kept.put([(v,) for v in keep])
        means = [sum(f) / len(f) if f else None for f in filled]
        yield batch.assign(n=[len(f) for f in frames], mean=means)[self.names]

    def close(self):
        pass


def over_rows_stream(df: DataFrame, keys: list[str], order: list[str], preceding: int, value: str) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        LastRows(value, preceding, order, schema.fieldNames()), outputStructType=schema, outputMode="append", timeMode="None"
    )


class PreviousValue(StatefulProcessor):
    """Emits a row when its value differs from the key's previous one."""

    def __init__(self, value: str, kind: str, order: list[str], names: list[str]):
        self.value, self.kind, self.order, self.names = value, kind, order, names

    def init(self, handle):
        self.last = handle.getValueState("last", f"v {self.kind}")

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, self.order)
        values = [_plain(v) for v in batch[self.value]]
        before = [self.last.get()[0] if self.last.exists() else None, *values[:-1]]
        self.last.update((values[-1],))
        # Null differs from nothing: neither a null nor the row after it is a change.
        hit = [b is not None and v is not None and b != v for b, v in zip(before, values)]
        batch["previous"] = pd.Series(before, index=batch.index, dtype=object)
        yield batch[hit][self.names]

    def close(self):
        pass


def changed_value_stream(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    schema = T.StructType([*df.schema.fields, T.StructField("previous", df.schema[value].dataType)])
    return df.groupBy(*keys).transformWithStateInPandas(
        PreviousValue(value, df.schema[value].dataType.simpleString(), order, schema.fieldNames()), outputStructType=schema, outputMode="append", timeMode="None"
    )


class WindowTotals(StatefulProcessor):
    """Adds up the closed windows of a key over its whole life."""

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle):
        self.total = handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows, timerValues):
        batch = _sorted(rows, ["window_start"])
        before = self.total.get()[0] if self.total.exists() else 0
        totals = before + batch["n"].cumsum()
        self.total.update((int(totals.iloc[-1]),))
        yield batch.assign(total=totals)[self.names]

    def close(self):
        pass


def cumulative_stream(df: DataFrame, ts: str, size: str, keys: list[str], delay_ms: int = 0) -> DataFrame:
    """Streaming form of ``windows.cumulative``: window counts once the window has closed, with the key's total."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{delay_ms} milliseconds")
    per = timed.groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    rows = per.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    schema = T.StructType([*rows.schema.fields, T.StructField("total", T.LongType())])
    return rows.groupBy(*keys).transformWithStateInPandas(
        WindowTotals(schema.fieldNames()), outputStructType=schema, outputMode="append", timeMode="None"
    )
