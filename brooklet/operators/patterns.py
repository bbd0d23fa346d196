"""Sequence patterns: ``begin`` / ``next`` (the very next row) / ``followed_by`` (the next row that matches).

A pattern compiles to one "next row" scan per step, so a whole pattern costs one shuffle by key. Every
row that satisfies the first step starts its own match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators.ordered import Next, Ordered

Getter = Callable[[str], Column]
Condition = Callable[..., Column]


@dataclass(frozen=True)
class Step:
    name: str
    condition: Condition
    strict: bool
    uses_start: bool = False


@dataclass(frozen=True)
class Pattern:
    """Steps with conditions. ``condition(row)`` gets a column getter; ``condition(row, start)`` also the start row's."""

    steps: tuple[Step, ...] = ()
    within_ms: int | None = None

    @staticmethod
    def begin(name: str, condition: Condition) -> Pattern:
        return Pattern((Step(name, condition, True),))

    def next(self, name: str, condition: Condition, uses_start: bool = False) -> Pattern:
        return self._plus(Step(name, condition, True, uses_start))

    def followed_by(self, name: str, condition: Condition) -> Pattern:
        """The condition may look at the candidate row only."""
        return self._plus(Step(name, condition, False))

    def within(self, ms: int) -> Pattern:
        """The last row must come less than ``ms`` after the first."""
        return Pattern(self.steps, ms)

    def _plus(self, step: Step) -> Pattern:
        return Pattern((*self.steps, step), self.within_ms)


def match(df: DataFrame, keys: list[str], order: list[str], ts: str, pattern: Pattern, columns: list[str]) -> DataFrame:
    """All matches and time-outs of ``pattern``.

    Result: the keys, ``outcome`` (``matched``, or ``timeout`` for a start that was still open when
    ``within`` ran out or the input ended) and one struct of ``columns`` per step, null where not reached.
    A condition that compares with the start row may use ``columns`` only.
    """
    first, later = pattern.steps[0], pattern.steps[1:]
    kept = [*dict.fromkeys([*columns, ts])]
    at_row: Getter = F.col
    if later and not any(s.strict for s in later):
        # Only rows that can take part matter when no step asks for the very next row.
        df = df.where(reduce(lambda a, b: a | b, [s.condition(at_row) for s in pattern.steps]))
    rows = Ordered(df, keys, order)

    # link_i at a row: the row that takes step i after it, with its own link to step i + 1 inside.
    link = None
    for i in range(len(later), 0, -1):
        step = later[i - 1]
        inside = [F.struct(*kept).alias("row")]
        if step.strict and not step.uses_start:
            inside.append(F.coalesce(step.condition(at_row), F.lit(False)).alias("ok"))
        if link is not None:
            inside.append(F.col(link).alias("rest"))
        where = None if step.strict else step.condition(at_row)
        link = f"__link{i}"
        rows = rows.scan(**{link: Next(F.struct(*inside), where=where)})

    begun = F.coalesce(first.condition(at_row), F.lit(False))
    starts = rows.result().where(begun)
    start_ms = epoch_ms(F.col(ts))
    outcome, path = None, F.col("__link1") if later else None
    taken: list[Column] = []
    alive = F.lit(True)
    for step in later:
        row = path["row"]
        here: Getter = lambda name, row=row: row[name]
        ended = path.isNull()
        if pattern.within_ms is not None:
            ended = ended | F.coalesce(epoch_ms(row[ts]) - start_ms >= pattern.within_ms, F.lit(False))
        ok = F.lit(True)
        if step.strict:
            ok = F.coalesce(step.condition(here, at_row), F.lit(False)) if step.uses_start else path["ok"]
            ok = F.coalesce(ok, F.lit(False))
        verdict = F.when(ended, F.lit("timeout")).when(~ok, F.lit("killed"))
        outcome = verdict if outcome is None else F.coalesce(outcome, verdict)
        alive = alive & ~ended & ok
        taken.append(F.when(alive, F.struct(*[row[c].alias(c) for c in columns])).alias(step.name))
        path = path["rest"] if step is not later[-1] else None
    outcome = F.lit("matched") if outcome is None else F.coalesce(outcome, F.lit("matched"))
    found = starts.select(*keys, outcome.alias("outcome"), F.struct(*columns).alias(first.name), *taken)
    allowed = ["matched"] if pattern.within_ms is None else ["matched", "timeout"]
    return found.where(F.col("outcome").isin(*allowed))
