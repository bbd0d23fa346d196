"""Window joins, lookups and lateral joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.operators.ordered import MOST_PROBES, broadcast_if_small, rows_per_slice
from brooklet.operators.windows import with_window
from brooklet.session import on_discard, saved


# Hot keys found by the latest joins, by session, both inputs, keys and limit; see ordered._PROBES.
_HOT_KEYS: dict[tuple, tuple[DataFrame, int] | None] = {}
on_discard(_HOT_KEYS.clear)


def _hot_keys(left: DataFrame, right: DataFrame, on: list[str], limit: int) -> tuple[DataFrame, int] | None:
    """Keys with more than ``limit`` rows on a side, as ``(__k0.., __rows, __cols)``: into how many parts each side is cut;
    and how many cells that makes. One aggregation over the keys of both inputs finds them."""
    known = (left.sparkSession.sparkContext.applicationId, left.semanticHash(), right.semanticHash(), *left.columns, *right.columns, *on, limit)
    if known not in _HOT_KEYS:
        while len(_HOT_KEYS) >= MOST_PROBES:
            _HOT_KEYS.pop(next(iter(_HOT_KEYS)))
        names = [f"__k{i}" for i in range(len(on))]
        sides = [df.dropna(subset=on).select(*[F.col(c).alias(n) for c, n in zip(on, names)], F.lit(side).alias("__side")) for side, df in enumerate((left, right))]
        parts = [F.ceil(F.count(F.when(F.col("__side") == side, 1)) / limit).cast("int").alias(name) for side, name in ((0, "__rows"), (1, "__cols"))]
        hot = sides[0].unionByName(sides[1]).groupBy(*names).agg(*parts).where("__rows > 1 OR __cols > 1")
        cells = hot.agg(F.sum(F.greatest("__rows", F.lit(1)) * F.greatest("__cols", F.lit(1)))).first()[0]
        _HOT_KEYS[known] = (saved(hot, "hot-join-keys"), cells) if cells else None
    return _HOT_KEYS[known]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join (``inner`` or ``left``) that cuts the hot keys of both sides.

    The left rows of a key with more than ``spark.brooklet.rowsPerSlice`` rows on a side are cut into parts below that
    number, and so are its right rows: every pair of parts is a cell of a grid, joined on its own, and a row is
    copied once for each part of the other side. All other keys are one cell. In a left join a row of a cut key
    whose cell is empty on the right is left to the other cells: the key has right rows, so it meets some. Rows
    with a null key meet nothing and are spread at random. Without a hot key this is a plain join.
    """
    limit = rows_per_slice(left)
    found = _hot_keys(left, right, on, limit)
    if found is None:
        return left.join(right, on, how)
    hot, cells = found
    hot = broadcast_if_small(hot, cells)
    names = [f"__k{i}" for i in range(len(on))]

    def with_parts(df: DataFrame) -> DataFrame:
        match = F.lit(True)
        for c, n in zip(on, names):
            match = match & (df[c] == hot[n])
        return df.join(hot, match, "left").select(*[df[c] for c in df.columns], "__rows", "__cols")

    def part(df: DataFrame, parts: str) -> Column:
        """A row's own part, by its content."""
        return F.coalesce(F.pmod(F.xxhash64(*df.columns), F.greatest(F.col(parts), F.lit(1))), F.lit(0)).cast("int")

    def each(parts: str) -> Column:
        """A copy for every part of the other side."""
        return F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(F.col(parts), F.lit(1)), F.lit(1)) - 1))

    alone = F.lit(False)
    for c in on:
        alone = alone | F.col(c).isNull()
    lone = F.pmod(F.xxhash64(*left.columns), F.lit(1 << 20)).cast("int")
    rows = with_parts(left).withColumns({"__i": F.when(alone, lone).otherwise(part(left, "__rows")), "__cut": F.coalesce(F.col("__cols") > 1, F.lit(False))})
    rows = rows.withColumn("__j", each("__cols")).drop("__rows", "__cols")
    cols = with_parts(right).withColumn("__j", part(right, "__cols")).withColumn("__i", each("__rows")).drop("__rows", "__cols")
    joined = rows.join(cols.withColumn("__met", F.lit(True)), [*on, "__i", "__j"], how)
    return joined.where(~F.col("__cut") | F.col("__met")).drop("__i", "__j", "__cut", "__met")


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    size_ms: int,
    how: str = "inner",
    last_by: list[str] | None = None,
) -> DataFrame:
    """Rows of both sides with equal keys in the same tumbling window.

    ``how`` is ``inner`` or ``left``. With ``last_by`` (arrival order of the right side) only the last
    right row per key and window takes part. The result has ``w_start``, ``w_end`` and, besides the
    keys, the columns of both sides, which must not share names.
    """
    l, r = with_window(left, left_ts, size_ms), with_window(right, right_ts, size_ms).drop("w_end")
    if last_by:
        values = [c for c in r.columns if c not in (*keys, "w_start")]
        newest = F.max_by(F.struct(*values), F.struct(*last_by)).alias("__r")
        r = r.groupBy(*keys, "w_start").agg(newest).select(*keys, "w_start", "__r.*")
    return salted_join(l, r, [*keys, "w_start"], how)


def lookup(df: DataFrame, table: DataFrame, keys: dict[str, str], prefix: str = "") -> DataFrame:
    """Complete each row from a keyed table (``keys``: column of ``df`` -> column of ``table``), null on a miss.

    The table has one row per key, so a hot key is one-sided: AQE splits its partition and copies one row.
    """
    back = {v: k for k, v in keys.items()}
    dim = table.select(*[F.col(c).alias(back.get(c, prefix + c)) for c in table.columns])
    return df.join(dim, list(keys), "left")


def lateral(df: DataFrame, call: Column | DataFrame, how: str = "inner") -> DataFrame:
    """Join every row with the rows a table function returns for it (``inner`` or ``left``)."""
    return df.lateralJoin(call, how=how)


def join_function(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size_ms: int, fn: Callable[[Callable[[str], Column], Callable[[str], Column]], list[Column]]
) -> DataFrame:
    """A user function over the pairs of a window join: ``fn(left, right)`` is given getters of the columns of both
    rows and returns the columns of the result."""
    pairs = window_join(left, right, keys, left_ts, right_ts, size_ms)
    return pairs.select(*fn(F.col, F.col))


def cogroup_function(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size_ms: int, fn: Callable[[Column, Column], Column], order: tuple[str, str]
) -> DataFrame:
    """A user function over the co-groups of a key and tumbling window: ``fn(left_rows, right_rows)`` is given both sides
    as arrays of structs, in the order of the column ``order`` names on each side, either perhaps empty, and returns
    an array of structs, the result's rows. A group is one row, so it has to fit into a task; ``window_join`` has
    no such bound."""
    sides = []
    for df, ts, name, by in ((left, left_ts, "__l", order[0]), (right, right_ts, "__r", order[1])):
        row = F.struct(F.col(by).alias("by"), F.struct(*df.columns).alias("row")).alias(name)
        sides.append(with_window(df, ts, size_ms).select(*keys, "w_start", row))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    groups = both.groupBy(*keys, "w_start").agg(*[F.transform(F.array_sort(F.collect_list(c)), lambda x: x["row"]).alias(c) for c in ("__l", "__r")])
    return groups.select(F.inline(fn(F.col("__l"), F.col("__r"))))


def join_with(joined: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The same with a pandas function, batch by batch: a row of ``joined`` has the columns of both sides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield fn(batch)

    return joined.mapInPandas(run, schema)


def window_cogroup(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, size_ms: int, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """``cogroup_function`` with a pandas function that gets all left and all right rows of a group."""
    l, r = with_window(left, left_ts, size_ms), with_window(right, right_ts, size_ms)
    group = [*keys, "w_start"]
    return l.groupBy(*group).cogroup(r.groupBy(*group)).applyInPandas(fn, schema)
