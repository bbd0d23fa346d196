"""Comparisons of two rows, written once for columns and for the values of rows kept in state.

A condition such as ``lambda row, start: row("ip") != start("ip")`` is called with getters. Given columns it makes
a Spark expression; given the getters below it records a function of the two rows. Null follows SQL: a comparison
with it is unknown, and unknown is no match.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from typing import Any

Rows = tuple[dict, dict]


class Term:
    """A value of the two rows, with the operators that conditions use."""

    def __init__(self, of: Callable[[Rows], Any]):
        self.of = of

    def _with(self, other: Any, op: Callable[[Any, Any], Any]) -> Term:
        left, right = self.of, other.of if isinstance(other, Term) else lambda rows: other

        def both(rows: Rows) -> Any:
            a, b = left(rows), right(rows)
            return None if a is None or b is None else op(a, b)

        return Term(both)

    def __eq__(self, other):  # type: ignore[override]
        return self._with(other, operator.eq)

    def __ne__(self, other):  # type: ignore[override]
        return self._with(other, operator.ne)

    def __lt__(self, other):
        return self._with(other, operator.lt)

    def __le__(self, other):
        return self._with(other, operator.le)

    def __gt__(self, other):
        return self._with(other, operator.gt)

    def __ge__(self, other):
        return self._with(other, operator.ge)

    def __add__(self, other):
        return self._with(other, operator.add)

    def __sub__(self, other):
        return self._with(other, operator.sub)

    def __mul__(self, other):
        return self._with(other, operator.mul)

    def __and__(self, other: Term) -> Term:
        return Term(lambda rows: _all(self.of(rows), other.of(rows)))

    def __or__(self, other: Term) -> Term:
        return Term(lambda rows: _not(_all(_not(self.of(rows)), _not(other.of(rows)))))

    def __invert__(self) -> Term:
        return Term(lambda rows: _not(self.of(rows)))

    def isNull(self) -> Term:  # noqa: N802
        return Term(lambda rows: self.of(rows) is None)

    def isNotNull(self) -> Term:  # noqa: N802
        return Term(lambda rows: self.of(rows) is not None)

    __hash__ = None  # type: ignore[assignment]


def _not(a: bool | None) -> bool | None:
    return None if a is None else not a


def _all(a: bool | None, b: bool | None) -> bool | None:
    if a is False or b is False:
        return False
    return None if a is None or b is None else True


def compiled(condition: Callable[..., Any]) -> Callable[[dict, dict], bool]:
    """``condition(row, start)`` as a function of the two rows' values."""
    term = condition(*(lambda name, i=i: Term(lambda rows: rows[i].get(name)) for i in (0, 1)))
    if not isinstance(term, Term):
        raise ValueError("on a stream a condition on two rows may use comparisons, + - *, &, |, ~ and isNull only")
    return lambda row, start: term.of((row, start)) is True
