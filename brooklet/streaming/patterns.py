"""Sequence patterns with time-outs on a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.operators.patterns import Pattern
from brooklet.streaming.compare import compiled
from brooklet.streaming.intime import InTimeOrder, State, as_json, from_json_rows, packed_rows, run_in_time_order


class PatternProcessor(InTimeOrder):
    """Keeps the open matches of a key: the step each waits for, when it began and the rows taken so far.

    Rows come with one flag per step and their columns as JSON; a step that compares with the start row has a
    function of the two rows instead. An open match is at most ``within`` old, which bounds the state.
    """

    def __init__(self, strict: list[bool], compare: list[Callable[[dict, dict], bool] | None], within_ms: int, orders: int, names: list[str]):
        super().__init__(names, orders)
        self.strict, self.compare, self.within = strict, compare, within_ms

    def start(self) -> State:
        return {"open": []}

    def _row(self, outcome: str, taken: list[str]) -> tuple:
        return (outcome, *taken, *[None] * (len(self.strict) - len(taken)))

    def _step(self, one: list, ms: int, values: dict) -> tuple[list | None, tuple | None]:
        """What becomes of an open match at a row, and what it gives out."""
        step, began, taken = one
        if ms - began >= self.within:
            return None, self._row("timeout", taken)
        compare = self.compare[step]
        fits = values.get(f"step{step}", False) if compare is None else compare(json.loads(values["row"]), json.loads(taken[0]))
        if not fits:
            return (None if self.strict[step] else one), None
        taken = [*taken, values["row"]]
        return (None, self._row("matched", taken)) if len(taken) == len(self.strict) else ([step + 1, began, taken], None)

    def take(self, state, ms, values):
        results = [self._step(one, ms, values) for one in state["open"]]
        state["open"] = [one for one, _ in results if one is not None]
        out = [o for _, o in results if o is not None]
        if values.get("step0", False):
            if len(self.strict) == 1:
                out.append(self._row("matched", [values["row"]]))
            else:
                state["open"].append([1, ms, [values["row"]]])
        return out

    def pass_time(self, state, mark):
        over = [one for one in state["open"] if one[1] + self.within < mark]
        state["open"] = [one for one in state["open"] if one[1] + self.within >= mark]
        return [self._row("timeout", taken) for _, _, taken in over]

    def due(self, state):
        return min((one[1] + self.within for one in state["open"]), default=None)


def match_stream(df: DataFrame, keys: list[str], order: list[str], ts: str, pattern: Pattern, columns: list[str], delay_ms: int = 0) -> DataFrame:
    """Streaming form of ``patterns.match`` with the same columns and, but for rows later than ``delay_ms``, the same
    result. Rows are taken in the order of ``ts`` and ``order``, once the watermark has passed them; a start still open
    when it has passed ``within`` comes out as ``timeout``. ``within`` is needed: it bounds the state. A condition that
    compares with the start row may use what ``compare`` knows."""
    if pattern.within_ms is None:
        raise ValueError("a pattern on a stream needs within: it bounds the state")
    compare = [compiled(s.condition) if s.uses_start else None for s in pattern.steps]
    values = {f"step{i}": F.coalesce(s.condition(F.col), F.lit(False)) for i, s in enumerate(pattern.steps) if not s.uses_start}
    extra = [c for c in order if c not in keys]
    rows = packed_rows(df, keys, extra, ts, delay_ms, {**values, "row": as_json(columns)})
    names = [s.name for s in pattern.steps]
    schema = T.StructType([*[df.schema[k] for k in keys], *[T.StructField(n, T.StringType()) for n in ("outcome", *names)]])
    processor = PatternProcessor([s.strict for s in pattern.steps], compare, pattern.within_ms, len(extra), schema.fieldNames())
    found = run_in_time_order(rows, keys, processor, schema)
    return found.select(*keys, "outcome", *[from_json_rows(n, df, columns) for n in names])
