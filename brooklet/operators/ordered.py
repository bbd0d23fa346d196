"""Per-key ordered scans that survive hot keys.

A running aggregate, a "previous row" or a "next matching row" is normally a window over
``PARTITION BY key ORDER BY time``. That puts every row of a key into one task, so a key holding a
third of the input holds up the whole job. :class:`Ordered` keeps the window, but cuts the keys that
are too big into consecutive slices of the order column and carries a small summary across the cuts:

1. *probe*: ``groupBy(key)`` row counts (map-side combined) when the scan is set up, once per input, keys
   and order in a session; only keys with more rows than ``spark.brooklet.rowsPerSlice`` stay. If there is
   none, the plan is the plain window and the rest of this list does not happen. At most
   ``rows / rowsPerSlice`` keys can stay (200,000 for 10**12 rows at the default). For these a second
   aggregation takes quantiles of the order column. The table of hot keys and their slice bounds is written
   once; it is broadcast up to ``BROADCAST_ROWS`` rows and shuffled beyond, like the summaries below.
2. *slice*: rows of such a key are cut at the quantiles, so that slices have equal numbers of rows however
   uneven the order column is; all other rows are in slice 0 of their key. Rows with the very same position
   stay together. A sequence without keys is always cut, into as many slices as the cluster runs tasks or more.
3. *scan*: one shuffle on (key, slice), one sort, ordinary window functions inside the slice.
4. *carry*: the sliced keys only are aggregated per (key, slice), a window over those few rows gives
   what comes before or after a slice, and a join hands it back. The aggregation and the windows read the
   same shuffle, so the input is read once, however many scans are chained.

Several scans on one :class:`Ordered` share the shuffle and the sort.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.session import on_discard, saved

ROWS_PER_SLICE = 5_000_000
BROADCAST_ROWS = 1_000_000
ROWS_PER_SLICE_CONF = "spark.brooklet.rowsPerSlice"

_SLICE, _HOT = "__slice", "__hot"
_FIRST = Window.unboundedPreceding


def rows_per_slice(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_SLICE_CONF, str(ROWS_PER_SLICE)))


def position(df: DataFrame, name: str) -> Column:
    """The order column as a number that grows with it."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(name)
    if isinstance(dtype, T.NumericType):
        return F.col(name)
    raise TypeError(f"order column {name} must be a number, date or timestamp, not {dtype.simpleString()}")


def null_safe(left: list[Column], right: list[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


def count_slices(hot: DataFrame, limit: int) -> int:
    """Slices of the hot keys ``(..., __n)`` together; no fewer than there are keys."""
    return hot.agg(F.sum(F.ceil(F.col("__n") / limit))).first()[0] or 0


MOST_CUTS = 2_000  # quantiles taken in one pass; beyond, every slice is cut again in a second one

# What the latest probes have found, by session, input, keys, order column and limit. Any bounds give right results,
# so a table that has changed meanwhile only makes slices uneven.
MOST_PROBES = 256
_PROBES: dict[tuple, Any] = {}
on_discard(_PROBES.clear)


def _quantiles(pos: Column, slices: int) -> Column:
    return F.percentile_approx(pos, F.array(*[F.lit(i / slices) for i in range(1, slices)]), 10_000)


def _doubles(values: list[float]) -> Column:
    """A constant array, however long, as one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def place_in(df: DataFrame, bounds: str, value: Column, most: int, name: str) -> DataFrame:
    """Add ``name``: how many of the ascending values of the array ``bounds`` (``most`` at most) are below ``value``.

    A binary search, one projection a step: each looks at one bound.
    """
    df = df.withColumns({"__value": value, name: F.lit(0)})
    step = 1 << max(most, 1).bit_length() - 1
    while step:
        below = F.get(bounds, F.col(name) + (step - 1)) < F.col("__value")
        df = df.withColumn(name, F.when(below, F.col(name) + step).otherwise(F.col(name)))
        step //= 2
    return df.drop("__value")


def probe_keys(probe: DataFrame, keys: list[str], slice_on: str, limit: int) -> tuple[DataFrame | None, int, int]:
    """The keys with more than ``limit`` rows and their slice bounds ``(__k0.., __bounds)``, None if there are
    none, how many slices they make, and the most bounds of one key."""
    pos = position(probe, slice_on).cast("double")
    names = [f"__k{i}" for i in range(len(keys))]
    counts = probe.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    most, keys_found = counts.agg(F.max("__n"), F.count(F.lit(1))).first()
    if not keys_found:
        return None, 0, 0
    slices = max(2, math.ceil(most / limit))
    coarse = min(slices, MOST_CUTS)
    hot = counts.select(*names)
    rows = probe.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(keys)], pos.alias("__pos"))
    match = null_safe([rows[f"__p{i}"] for i in range(len(keys))], [hot[n] for n in names])
    rows = rows.join(broadcast_if_small(hot, keys_found), match).select(*names, "__pos")
    bounds = rows.groupBy(*names).agg(_quantiles(F.col("__pos"), coarse).alias("__bounds"))
    if slices > coarse:
        fine = math.ceil(slices / coarse)
        other = bounds.select(*[F.col(n).alias(f"__b{i}") for i, n in enumerate(names)], "__bounds")
        joined = rows.join(broadcast_if_small(other, keys_found * coarse), null_safe([rows[n] for n in names], [other[f"__b{i}"] for i in range(len(names))]))
        cut = place_in(joined.select(*names, "__pos", "__bounds"), "__bounds", F.col("__pos"), coarse, "__part")
        inner = cut.groupBy(*names, "__part").agg(F.concat(F.array(F.max("__pos")), _quantiles(F.col("__pos"), fine)).alias("__more"))
        bounds = inner.groupBy(*names).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__more")))).alias("__bounds"))
        slices = coarse * (fine + 1)
    return saved(bounds, "hot-keys"), keys_found * slices, slices


def probe_sequence(probe: DataFrame, slice_on: str, limit: int) -> list[float]:
    """The slice bounds of a sequence without keys."""
    pos = position(probe, slice_on).cast("double")
    tasks = probe.sparkSession.sparkContext.defaultParallelism
    fine = 256
    n, marks = probe.agg(F.count(F.lit(1)), _quantiles(pos, fine)).first()
    if not n or marks is None:
        return []
    slices = max(2, tasks, math.ceil(n / limit))
    if slices <= fine:
        return sorted({marks[round(i * fine / slices) - 1] for i in range(1, slices)})
    coarse = min(slices, MOST_CUTS)
    marks = sorted(set(probe.agg(_quantiles(pos, coarse)).first()[0]))
    if slices > coarse:
        rows = probe.select(pos.alias("__pos"), _doubles(marks).alias("__bounds"))
        cut = place_in(rows, "__bounds", F.col("__pos"), len(marks), "__part")
        more = cut.groupBy("__part").agg(_quantiles(F.col("__pos"), math.ceil(slices / coarse) + 1).alias("__more"))
        marks = sorted({*marks, *(m for r in more.collect() for m in r["__more"] or [])})  # one number a slice
    return marks


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class Frame:
    """The windows a scan works with: inside a slice (both directions) and across slices."""

    order: list[str]
    forward: Any
    backward: Any
    before: Any
    after: Any

    def order_struct(self) -> Column:
        return F.struct(*self.order)


class Scan:
    """One column of a scan. ``payload`` columns are wrapped in a struct so that null values count."""

    broadcast_carry = True

    def local(self, fr: Frame) -> Column:
        raise NotImplementedError

    def whole(self, fr: Frame) -> Column:
        """The column for a key that is not cut."""
        return self.local(fr)

    def partial(self, fr: Frame) -> Column:
        raise NotImplementedError

    def carry(self, fr: Frame, partial: Column) -> Column:
        raise NotImplementedError

    def combine(self, local: Column, carry: Column) -> Column:
        raise NotImplementedError


def _upto(window, inclusive: bool):
    return window.rowsBetween(_FIRST, 0 if inclusive else -1)


class Sum(Scan):
    def __init__(self, value: Column | str, inclusive: bool = True):
        self.value, self.inclusive = _column(value), inclusive

    def local(self, fr):
        return F.sum(self.value).over(_upto(fr.forward, self.inclusive))

    def partial(self, fr):
        return F.sum(self.value)

    def carry(self, fr, partial):
        return F.sum(partial).over(fr.before)

    def combine(self, local, carry):
        return F.coalesce(carry + local, carry, local)


class Count(Sum):
    """Rows so far, or rows so far for which ``where`` holds."""

    def __init__(self, where: Column | None = None, inclusive: bool = True):
        one = F.lit(1) if where is None else F.when(where, F.lit(1)).otherwise(F.lit(0))
        super().__init__(one.cast("long"), inclusive)

    def combine(self, local, carry):
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))

    def whole(self, fr):
        return F.coalesce(self.local(fr), F.lit(0))


class Max(Scan):
    agg, pick = staticmethod(F.max), staticmethod(F.greatest)

    def __init__(self, value: Column | str, inclusive: bool = True):
        self.value, self.inclusive = _column(value), inclusive

    def local(self, fr):
        return self.agg(self.value).over(_upto(fr.forward, self.inclusive))

    def partial(self, fr):
        return self.agg(self.value)

    def carry(self, fr, partial):
        return self.agg(partial).over(fr.before)

    def combine(self, local, carry):
        return self.pick(carry, local)


class Min(Max):
    agg, pick = staticmethod(F.min), staticmethod(F.least)


class Last(Scan):
    """``payload`` of the latest row for which ``where`` holds; exclusive by default."""

    def __init__(self, payload: Column | str, where: Column | None = None, inclusive: bool = False):
        self.boxed = F.struct(_column(payload).alias("v"))
        self.where, self.inclusive = where, inclusive

    def _marked(self, what: Column) -> Column:
        return what if self.where is None else F.when(self.where, what)

    def local(self, fr):
        if self.where is None and not self.inclusive:
            return F.lag(self.boxed).over(fr.forward)
        return F.last(self._marked(self.boxed), ignorenulls=True).over(_upto(fr.forward, self.inclusive))

    def partial(self, fr):
        return F.max_by(self.boxed, self._marked(fr.order_struct()))

    def carry(self, fr, partial):
        return F.last(partial, ignorenulls=True).over(fr.before)

    def combine(self, local, carry):
        return F.coalesce(local, carry).getField("v")

    def whole(self, fr):
        return self.local(fr).getField("v")


class Next(Last):
    """``payload`` of the first later row for which ``where`` holds."""

    def local(self, fr):
        if self.where is None:
            return F.lead(self.boxed).over(fr.forward)
        # Spark's "following" frames restart for every row; a descending running frame does not.
        return F.last(self._marked(self.boxed), ignorenulls=True).over(_upto(fr.backward, False))

    def partial(self, fr):
        return F.min_by(self.boxed, self._marked(fr.order_struct()))

    def carry(self, fr, partial):
        return F.last(partial, ignorenulls=True).over(fr.after)


class History(Scan):
    """The list of all values so far. One output cell holds the whole history, by definition."""

    broadcast_carry = False

    def __init__(self, value: Column | str):
        self.value = _column(value)

    def local(self, fr):
        return F.collect_list(self.value).over(_upto(fr.forward, True))

    def partial(self, fr):
        return F.transform(
            F.array_sort(F.collect_list(F.struct(fr.order_struct().alias("o"), self.value.alias("v")))),
            lambda x: x["v"],
        )

    def carry(self, fr, partial):
        return F.flatten(F.collect_list(partial).over(fr.before))

    def combine(self, local, carry):
        return F.concat(F.coalesce(carry, F.array()), local)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


class Ordered:
    """Rows of ``df`` grouped by ``keys`` (none = one global sequence), ordered by ``order``.

    ``order`` names ascending columns that together are unique within a key. ``slice_on`` is the
    order column hot keys are cut on (the first one by default): it should spread evenly.
    ``probe`` may name a cheaper DataFrame with at least the same rows per key, e.g. the bare input.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        slice_on: str | None = None,
        probe: DataFrame | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        slice_on = slice_on or self.order[0]
        limit = rows_per_slice(df)
        probe = df if probe is None else probe
        own = position(df, slice_on).cast("double")
        self.sliced, self.slices, self.df = False, 0, df
        session = probe.sparkSession.sparkContext.applicationId
        known = (session, probe.semanticHash(), tuple(probe.columns), tuple(self.keys), slice_on, limit)
        if known not in _PROBES:
            while len(_PROBES) >= MOST_PROBES:
                _PROBES.pop(next(iter(_PROBES)))
            _PROBES[known] = probe_keys(probe, self.keys, slice_on, limit) if self.keys else probe_sequence(probe, slice_on, limit)
        if self.keys:
            hot, self.slices, most = _PROBES[known]
            if hot is None:
                return
            names = [f"__k{i}" for i in range(len(self.keys))]
            bounds = broadcast_if_small(hot, self.slices)
            joined = df.join(bounds, null_safe([df[k] for k in self.keys], [bounds[n] for n in names]), "left")
            joined = joined.select(*[df[c] for c in df.columns], "__bounds")
            cut = place_in(joined, "__bounds", own, most, _SLICE).withColumn(_HOT, F.col("__bounds").isNotNull()).drop("__bounds")
        else:
            marks = _PROBES[known]
            if not marks:
                return
            self.slices = len(marks) + 1
            marked = df.withColumns({_HOT: F.lit(True), "__bounds": _doubles(marks)})
            cut = place_in(marked, "__bounds", own, len(marks), _SLICE).drop("__bounds")
        # Both readers of the shuffle must ask for the same columns to share it; the observation needs them all.
        dealt = cut.repartition(*self.keys, _HOT, _SLICE)
        never = F.when(F.col(_SLICE) < 0, F.struct(*[F.col(f"`{c}`") for c in dealt.columns]))
        self.df = dealt.observe(f"sliced-{uuid.uuid4().hex}", F.count(never).alias("misplaced"))
        self.sliced = True

    def _frame(self) -> Frame:
        cut = [_HOT, _SLICE] if self.sliced else []
        rows = Window.partitionBy(*(self.keys + cut or [F.lit(0)]))
        slices = Window.partitionBy(*self.keys, *cut[:1])
        return Frame(
            self.order,
            rows.orderBy(*self.order),
            rows.orderBy(*[F.col(c).desc() for c in self.order]),
            slices.orderBy(_SLICE).rowsBetween(_FIRST, -1),
            slices.orderBy(F.col(_SLICE).desc()).rowsBetween(_FIRST, -1),
        )

    def scan(self, **scans: Scan) -> Ordered:
        """Add one column per scan. All of them see the columns present before the call."""
        fr, df = self._frame(), self.df
        by = [*self.keys, _HOT, _SLICE]
        plain = [c for c in df.columns if c not in scans]
        if not self.sliced:
            return self._with(df.select(*plain, *[s.whole(fr).alias(n) for n, s in scans.items()]))
        rows = df.select(*plain, *[s.local(fr).alias(f"__l_{n}") for n, s in scans.items()])
        cut = df.where(F.col(_HOT)).groupBy(*by).agg(*[s.partial(fr).alias(f"__p_{n}") for n, s in scans.items()])
        names = [f"__c{i}" for i in range(len(by))]
        carry = cut.select(
            *[F.col(c).alias(n) for c, n in zip(by, names)],
            *[s.carry(fr, F.col(f"__p_{n}")).alias(f"__c_{n}") for n, s in scans.items()],
        )
        if all(s.broadcast_carry for s in scans.values()):
            carry = broadcast_if_small(carry, self.slices)
        joined = rows.join(carry, null_safe([rows[c] for c in by], [carry[n] for n in names]), "left")
        out = [s.combine(F.col(f"__l_{n}"), F.col(f"__c_{n}")).alias(n) for n, s in scans.items()]
        return self._with(joined.select(*[rows[c] for c in plain], *out))

    def with_columns(self, **columns: Column) -> Ordered:
        return self._with(self.df.withColumns(columns))

    def result(self, *columns: Column | str) -> DataFrame:
        """The rows without the helper columns, or only ``columns``."""
        return self.df.select(*columns) if columns else self.df.drop(_HOT, _SLICE)

    def _with(self, df: DataFrame) -> Ordered:
        twin = object.__new__(Ordered)
        twin.keys, twin.order, twin.df = self.keys, self.order, df
        twin.sliced, twin.slices = self.sliced, self.slices
        return twin
