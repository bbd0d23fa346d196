"""Keyed state machines with timers, for what windows cannot express.

A machine is a small pure step function, shared by the batch replay below and the streaming processor.
The replay cuts each key at rows where the state is known without looking back (*reset* rows: a silence
longer than every timer, a row that clears the state). The pieces are independent, and rows stream through a task
with nothing but the machine state in memory.

A piece that is still too long for one task is cut into slices (as ``Ordered`` cuts keys), and the slices are composed:

1. every slice is summarised on its own: which state it leaves for each state it may be entered in;
2. the summaries of a piece, a few numbers a slice, are folded in order, which gives every slice its entry state;
3. every slice runs once from there and emits.

Machines with one timer that is armed, fires and is armed again have a complete summary: the moment from which the next
row may arm decides everything, and the moment that a slice leaves is a step function of it. Other machines try
the states that a run through the rows before the slice leads to; should the true one not be among them, the slice
is summarised again from it, until all are known.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Count, Last, Next, Ordered, Scan, broadcast_if_small, null_safe
from brooklet.session import saved

State = dict[str, Any]
Emitted = list[tuple]


class Machine:
    """``emits`` is the DDL of the emitted columns, ``needs`` the input columns a step reads besides ``__ms``.

    ``timer_first``: a timer due at the very time of a row fires before it (else after it).
    """

    emits = ""
    needs: list[str] = []
    previous: dict[str, str] = {}  # of ``needs``, those that are a column's value in the key's previous row
    timer_first = True

    def start(self) -> State:
        raise NotImplementedError

    def due(self, state: State) -> int | None:
        raise NotImplementedError

    def fire(self, state: State, at: int) -> Emitted:
        raise NotImplementedError

    def row(self, state: State, ms: int, *values: Any) -> Emitted:
        raise NotImplementedError

    def advance(self, state: State, until: int | None, include: bool) -> Emitted:
        """Fire the timers due before ``until`` (all of them for None)."""
        out: Emitted = []
        at = self.due(state)
        while at is not None and (until is None or at < until or (include and at == until)):
            out.extend(self.fire(state, at))
            at = self.due(state)
        return out

    def frozen(self, state: State) -> str:
        """A state as text; equal texts mean states that behave alike."""
        return json.dumps(state, sort_keys=True)

    def summary(self, first: bool, extra: list[str]) -> Summary:
        """An empty summary of a slice; ``first`` of its piece, or entered in one of the states ``extra`` perhaps."""
        return Trials(self, first, extra)

    def through(self, summaries: list[dict], state: State) -> State | None:
        """The state in which a slice leaves that is entered in ``state``; None if its summaries do not tell."""
        entry = self.frozen(state)
        for one in summaries:
            if entry in one["exits"]:
                return json.loads(one["exits"][entry])
        return None


class Summary:
    def add(self, ms: list[int], values: list[list], before: bool) -> None:
        """Rows in order, first those from ``before`` the slice."""
        raise NotImplementedError

    def done(self) -> dict:
        raise NotImplementedError


class Trials(Summary):
    """Runs a slice from every state it may be entered in. Runs that meet go on as one."""

    def __init__(self, machine: Machine, first: bool, extra: list[str]):
        self.machine, self.ready = machine, first or bool(extra)
        # Two runs through the rows before the slice: from the first of them, and from the second.
        self.before: list[State] = []
        self.runs: dict[str, tuple[list[str], State]] = {}
        for entry in [machine.frozen(machine.start())] if first else extra:
            self.runs[entry] = ([entry], json.loads(entry))

    def _step(self, state: State, ms: int, values: tuple) -> None:
        self.machine.advance(state, ms, self.machine.timer_first)
        self.machine.row(state, ms, *values)

    def add(self, ms, values, before):
        if before and self.ready:
            return
        if before:
            for at, *row in zip(ms, *values):
                for state in self.before:
                    self._step(state, at, row)
                if not self.before:
                    self.before = [self.machine.start(), self.machine.start()]
                    self._step(self.before[0], at, row)
            return
        if not self.ready:
            self.ready = True
            for state in self.before or [self.machine.start()]:
                entry = self.machine.frozen(state)
                self.runs[entry] = ([entry], json.loads(entry))
        states = [state for _, state in self.runs.values()]
        for at, *row in zip(ms, *values):
            for state in states:
                self._step(state, at, row)
        met: dict[str, tuple[list[str], State]] = {}
        for entries, state in self.runs.values():
            met.setdefault(self.machine.frozen(state), ([], state))[0].extend(entries)
        self.runs = met

    def done(self):
        return {"exits": {entry: self.machine.frozen(state) for entries, state in self.runs.values() for entry in entries}}


class Rearming(Machine):
    """A machine whose one timer is armed by the first row of a kind, fires ``interval`` later and can be armed again.

    The state has ``timer`` and a second value. Inside a piece nothing but firing ends a timer, so all that matters
    of the past is from when on a row may arm.
    """

    interval: int

    def arms(self, values: list[list]) -> list[bool]:
        raise NotImplementedError

    def left(self, state: State, timer: int | None, told: dict, since: int | None) -> State:
        """The state after a slice: its timer, what the summary tells, the number of the row that armed last."""
        raise NotImplementedError

    def summary(self, first, extra):
        return _Rearmings(self)

    def through(self, summaries, state):
        told = summaries[0]
        due = state["timer"]
        free = due is None
        steps = [i for i, top in enumerate(told["tops"]) if free or top > due or (self.timer_first and top == due)]
        since = told["armed"][steps[0]] if steps else None
        timer = told["dues"][steps[0]] if steps else due
        fired = timer is not None and (timer < told["end"] or (self.timer_first and timer == told["end"]))
        return self.left(state, None if fired else timer, told, since)


class _Rearmings(Summary):
    """``tops``, ``dues``, ``armed``: entered with a timer up to ``tops[i]`` (above ``tops[i - 1]``), a slice leaves with
    ``dues[i]``, which its arming row ``armed[i]`` has set."""

    def __init__(self, machine: Rearming):
        self.machine, self.ms, self.rows, self.end, self.last = machine, [], 0, None, None

    def add(self, ms, values, before):
        if before or not ms:
            return
        arms = np.array(self.machine.arms(values), dtype=bool)
        self.ms.append(np.array(ms, dtype=np.int64)[arms])
        self.rows += int(arms.sum())
        self.end, self.last = int(ms[-1]), values[0][-1]

    def done(self):
        at = np.concatenate(self.ms) if self.ms else np.zeros(0, np.int64)
        side = "left" if self.machine.timer_first else "right"
        follow = np.searchsorted(at, at + self.machine.interval, side)
        last = np.where(follow < len(at), follow, np.arange(len(at)))
        while len(at) and (last[last] != last).any():  # doubles the way with every round
            last = last[last]
        ends = np.flatnonzero(np.append(last[1:] != last[:-1], True)) if len(at) else np.zeros(0, np.int64)
        return {
            "tops": at[ends].tolist(), "dues": (at[last[ends]] + self.machine.interval).tolist(), "armed": last[ends].tolist(),
            "rows": self.rows, "end": self.end, "last": self.last,
        }


class RisingAlert(Rearming):
    """Alert when a value has not fallen for ``interval_ms`` after a rise: ``(at_ms, value)``.

    ``prev`` is the key's previous value. A rise arms the timer if none is pending, a fall cancels it.
    """

    emits, needs = "at_ms long, value double", ["value", "prev"]
    previous = {"prev": "value"}

    def __init__(self, interval_ms: int):
        self.interval = interval_ms

    def start(self):
        return {"timer": None, "value": None}

    def due(self, state):
        return state["timer"]

    def fire(self, state, at):
        state["timer"] = None
        return [(at, state["value"])]

    def row(self, state, ms, value, prev):
        known = prev is not None and value is not None
        if known and value > prev and state["timer"] is None:
            state["timer"] = ms + self.interval
        elif known and value < prev:
            state["timer"] = None
        state["value"] = value
        return []

    def arms(self, values):
        return [value is not None and prev is not None and value > prev for value, prev in zip(*values)]

    def left(self, state, timer, told, since):
        return {"timer": timer, "value": told["last"]}


class FailBurst(Rearming):
    """``(at_ms, fails)`` when ``min_count`` fails come within ``interval_ms`` of the first without a success."""

    emits, needs = "at_ms long, fails long", ["failed"]
    timer_first = False

    def __init__(self, interval_ms: int, min_count: int):
        self.interval, self.min_count = interval_ms, min_count

    def start(self):
        return {"timer": None, "fails": 0}

    def due(self, state):
        return state["timer"]

    def fire(self, state, at):
        fails = state["fails"]
        state.update(timer=None, fails=0)
        return [(at, fails)] if fails >= self.min_count else []

    def row(self, state, ms, failed):
        if failed:
            state["fails"] += 1
            if state["timer"] is None:
                state["timer"] = ms + self.interval
        else:
            state.update(timer=None, fails=0)
        return []

    def arms(self, values):
        return [bool(failed) for failed in values[0]]

    def left(self, state, timer, told, since):
        if timer is None:
            return {"timer": None, "fails": 0}
        return {"timer": timer, "fails": told["rows"] - since if since is not None else state["fails"] + told["rows"]}


class PairSum(Machine):
    """Adds the values of two streams: ``(at_ms, kind, total)`` with kind ``sum``, ``left`` or ``right``.

    The first value waits ``timeout_ms`` for the other side. A repeat on the same side replaces the value
    and starts another timer; the older timer stays and gives the newer value away early.
    """

    emits, needs = "at_ms long, kind string, total double", ["src", "n"]

    def __init__(self, timeout_ms: int):
        self.timeout = timeout_ms

    def start(self):
        return {"left": None, "right": None, "timers": [], "latest": None}

    def due(self, state):
        return min(state["timers"]) if state["timers"] else None

    def fire(self, state, at):
        state["timers"].remove(at)
        out = [(at, side, state[side]) for side in ("left", "right") if state[side] is not None]
        state.update(left=None, right=None)
        return out

    def row(self, state, ms, src, n):
        other = state["right" if src == "left" else "left"]
        if other is None:
            state[src], state["latest"] = n, ms + self.timeout
            if state["latest"] not in state["timers"]:
                state["timers"].append(state["latest"])
            return []
        if state["latest"] in state["timers"]:
            state["timers"].remove(state["latest"])
        state.update(left=None, right=None, latest=None)
        return [(ms, "sum", n + other)]

    def frozen(self, state):
        latest = state["latest"] if state["latest"] in state["timers"] else None
        return json.dumps({**state, "timers": sorted(state["timers"]), "latest": latest}, sort_keys=True)


class _Feed:
    """Rows of sorted groups, batch by batch: for every run of rows of one group its key and columns as lists."""

    def __init__(self, group: int):
        self.group = group

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[list]]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_pylist() for c in batch.columns]
            at, n = 0, batch.num_rows
            keys = list(zip(*columns[: self.group]))
            while at < n:
                end = at + 1
                while end < n and keys[end] == keys[at]:
                    end += 1
                yield keys[at], [c[at:end] for c in columns[self.group :]]
                at = end


def _emitted(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _runner(machine: Machine, n_keys: int, group: int, schema: pa.Schema, entered: bool):
    """Runs groups of rows ``(group.., [entry, last], ms, after, needs..)`` and emits. ``entered``: slices that come with the state they
    are entered in; only the last one of a piece ends its timers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, until, ends = None, machine.start(), None, True
        out: list[tuple] = []

        def finish() -> None:
            # The row that cuts a piece off ends its timers: they fire before it or not at all.
            if current is not None and ends:
                out.extend(current[:n_keys] + e for e in machine.advance(state, until, machine.timer_first))

        for key, columns in _Feed(group)(batches):
            extra, (ms, after, *needs) = (columns[:2], columns[2:]) if entered else (None, columns)
            if key != current:
                finish()
                current, state, ends = key, machine.start(), True
                if entered:
                    state, ends = json.loads(extra[0][0]), extra[1][0]
            for at, *values in zip(ms, *needs):
                for e in machine.advance(state, at, machine.timer_first):
                    out.append(key[:n_keys] + e)
                for e in machine.row(state, at, *values):
                    out.append(key[:n_keys] + e)
            until = after[-1]
            if len(out) > 10_000:
                yield _emitted(out, schema)
                out = []
        finish()
        yield _emitted(out, schema)

    return run


_PART = "__part"


def _entries(hot: DataFrame, group: list[str], order: list[str], machine: Machine, idle_ms: int, slices: int) -> DataFrame:
    """``(group.., __part, entry, last)``: the state in which every slice is entered."""
    by = [*group, _PART]
    firsts = hot.groupBy(*by).agg(F.min("__ms").alias("__first"))
    line = Window.partitionBy(*group).orderBy(_PART)
    firsts = saved(firsts.select(*by, F.lead(_PART).over(line).alias("__next"), F.lead("__first").over(line).alias("__next_first"), (F.row_number().over(line) == 1).alias("__head")), "machine-parts")
    other = broadcast_if_small(firsts.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], "__next", "__next_first", "__head"), slices)
    known = hot.join(other, null_safe([hot[c] for c in by], [other[f"__b{i}"] for i in range(len(by))]))
    columns = [*by, "__old", "__head", *order, "__ms", *machine.needs]
    columns = [*dict.fromkeys(columns)]
    own = known.withColumn("__old", F.lit(False)).select(*columns)
    near = F.col("__next_first") - F.col("__ms") <= 2 * idle_ms
    before = known.where(near).withColumns({"__old": F.lit(True), _PART: F.col("__next"), "__head": F.lit(False)}).select(*columns)

    def summarise(rows: DataFrame) -> DataFrame:
        """``rows`` have the states to try, as a list of texts, in ``__extra``."""
        kinds = rows.select(*by).schema
        schema = T.StructType([*kinds.fields, T.StructField("summary", T.StringType())])
        arrow, size = to_arrow_schema(schema), len(by)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, summary = None, None
            for key, (old, head, extra, ms, *needs) in _Feed(size)(batches):
                if key != current:
                    if current is not None:
                        yield _emitted([(*current, json.dumps(summary.done()))], arrow)
                    current, summary = key, machine.summary(head[0], extra[0] or [])
                cut = sum(old)  # rows from before come first
                summary.add(ms[:cut], [n[:cut] for n in needs], True)
                summary.add(ms[cut:], [n[cut:] for n in needs], False)
            if current is not None:
                yield _emitted([(*current, json.dumps(summary.done()))], arrow)

        dealt = rows.repartition(*by).sortWithinPartitions(*by, F.col("__old").desc(), *order)
        return dealt.select(*by, "__old", "__head", "__extra", "__ms", *machine.needs).mapInArrow(run, schema)

    found = saved(summarise(own.unionByName(before).withColumn("__extra", F.lit(None).cast("array<string>"))), "machine-summaries")
    heads = T.StructType([*hot.select(*by).schema.fields, *T.StructType.fromDDL("entry string, last boolean, extra array<string>").fields])

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        """Entry states as far as they are known; beyond, the states to try."""
        state: State | None = machine.start()
        out, tried = [], []
        parts = [(part, [json.loads(s) for s in own_rows["summary"]], own_rows.iloc[0]) for part, own_rows in rows.groupby(_PART)]
        for i, (_, summaries, row) in enumerate(sorted(parts, key=lambda p: p[0])):
            exits = [e for s in summaries for e in s.get("exits", {}).values()]
            own = {e for s in summaries for e in s.get("exits", {})}
            entry = None if state is None else machine.frozen(state)
            after = None if state is None else machine.through(summaries, state)
            extra = [] if after is not None else sorted({*tried, *([entry] if entry else [])} - own)
            out.append((*[row[c] for c in by], entry, i == len(parts) - 1, extra))
            state, tried = after, exits
        return pd.DataFrame(out, columns=[*by, "entry", "last", "extra"])

    while True:
        states = saved(found.groupBy(*group).applyInPandas(fold, heads), "machine-entries")
        asked = states.where(F.size("extra") > 0)
        if asked.isEmpty():
            return states.drop("extra")
        more = asked.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], F.col("extra").alias("__extra"))
        again = own.join(broadcast_if_small(more, slices), null_safe([own[c] for c in by], [more[f"__b{i}"] for i in range(len(by))])).select(*columns, "__extra")
        found = saved(found.unionByName(summarise(again)), "machine-summaries")


def replay(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    ts: str,
    machine: Machine,
    reset: Column | None,
    idle_ms: int,
    **scans: Scan,
) -> DataFrame:
    """Run ``machine`` over every key in ``order``; its timers all fire at the end of the input.

    A row after a silence of ``idle_ms`` (longer than any timer) and a row with ``reset`` start a new piece.
    ``scans`` are extra columns the machine or ``reset`` needs from the neighbouring rows.
    """
    timed = df.withColumn("__ms", epoch_ms(F.col(ts)))
    rows = Ordered(timed, keys, order).scan(__before=Last("__ms"), __after=Next("__ms"), **scans)
    gap = F.col("__ms") - F.col("__before")
    quiet = (gap >= idle_ms) if machine.timer_first else (gap > idle_ms)
    cut = F.coalesce(quiet, F.lit(False))
    if reset is not None:
        cut = cut | F.coalesce(reset, F.lit(False))
    pieces = rows.scan(__piece=Count(cut)).result()
    slim = pieces.select(*keys, "__piece", *order, "__ms", "__after", *[c for c in machine.needs if c not in (*keys, *order)])
    doubles = {c: F.when(~F.isnan(c), F.col(c)) for c in machine.needs if slim.schema[c].dataType in (T.DoubleType(), T.FloatType())}
    slim = slim.withColumns(doubles) if doubles else slim
    group = [*keys, "__piece"]
    out_schema = T.StructType([df.schema[k] for k in keys] + T.StructType.fromDDL(machine.emits).fields)
    arrow = to_arrow_schema(out_schema)

    def whole(part: DataFrame) -> DataFrame:
        dealt = part.repartition(*group).sortWithinPartitions(*group, *order)
        return dealt.select(*group, "__ms", "__after", *machine.needs).mapInArrow(_runner(machine, len(keys), len(group), arrow, False), out_schema)

    if not rows.sliced:  # no key is too long, so no piece is
        return whole(slim)
    line = Ordered(saved(slim, "machine-rows"), group, order)
    if not line.sliced:
        return whole(line.df)
    dealt = saved(line.df.withColumnsRenamed({"__slice": _PART, "__hot": "__long"}), "machine-slices")
    hot = dealt.where("__long")
    states = _entries(hot, group, order, machine, idle_ms, line.slices)
    by = [*group, _PART]
    other = broadcast_if_small(states.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(by)], "entry", "last"), line.slices)
    known = hot.join(other, null_safe([hot[c] for c in by], [other[f"__b{i}"] for i in range(len(by))]))
    entered = known.repartition(*by).sortWithinPartitions(*by, *order).select(*by, "entry", "last", "__ms", "__after", *machine.needs)
    run = entered.mapInArrow(_runner(machine, len(keys), len(by), arrow, True), out_schema)
    return whole(dealt.where("NOT __long")).unionByName(run)


def rising_alert(df: DataFrame, keys: list[str], order: list[str], ts: str, value: str, interval_ms: int) -> DataFrame:
    """See :class:`RisingAlert`. A fall resets the state, so pieces are runs that do not fall."""
    rows = df.withColumn("value", F.col(value).cast("double"))
    falls = F.col("value") < F.col("prev")
    return replay(rows, keys, order, ts, RisingAlert(interval_ms), falls, interval_ms, prev=Last("value"))


def fail_burst(
    df: DataFrame, keys: list[str], order: list[str], ts: str, fail: Column, success: Column, interval_ms: int, min_count: int = 2
) -> DataFrame:
    """See :class:`FailBurst`. A success resets the state; other rows play no part."""
    rows = df.withColumn("failed", F.when(fail, True).when(success, False)).where(F.col("failed").isNotNull())
    return replay(rows, keys, order, ts, FailBurst(interval_ms, min_count), ~F.col("failed"), interval_ms)


def pair_sum(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], ts: str, value: str, timeout_ms: int) -> DataFrame:
    """See :class:`PairSum`. ``order`` must be unique over both inputs together."""
    both = [df.select(*dict.fromkeys([*keys, *order, ts]), F.lit(src).alias("src"), F.col(value).cast("double").alias("n"))
            for src, df in (("left", left), ("right", right))]
    return replay(both[0].unionByName(both[1]), keys, order, ts, PairSum(timeout_ms), None, timeout_ms)
