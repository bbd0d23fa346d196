"""Wide-column rows ``rowkey STRING, cols MAP<STRING,STRING>``; cells are named ``family:column``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The comparison names of the term grammar, spelt as the terms have them.
_COMPARE = {
    "less": lambda a, b: a < b,
    "less_or_equal": lambda a, b: a <= b,
    "greated": lambda a, b: a > b,
    "greated_or_equal": lambda a, b: a >= b,
    "not_equal": lambda a, b: a != b,
}


def cell(name: str) -> Column:
    return F.try_element_at(F.col("cols"), F.lit(name))


def _named(term: str) -> tuple[str, str]:
    """``family:column:value`` to (cell name, value)."""
    family, column, value = term.split(":", 2)
    return f"{family.strip()}:{column}", value


def equals(term: str) -> Column:
    """Cell equals a value; the value ``null`` or nothing also keeps rows without the cell."""
    name, value = _named(term)
    same = cell(name) == F.lit(value)
    return cell(name).isNull() | same if value.lower() in ("null", "") else F.coalesce(same, F.lit(False))


def interval(term: str) -> Column:
    """``op:family:column:value`` compared as bytes. Rows without the cell stay; an unknown term filters nothing."""
    op, _, rest = term.strip().partition(":")
    if op not in _COMPARE or rest.count(":") < 2:
        return F.lit(True)
    name, value = _named(rest)
    return cell(name).isNull() | _COMPARE[op](cell(name), F.lit(value))


def matches(term: str) -> Column:
    name, pattern = _named(term)
    return cell(name).isNull() | cell(name).rlike(pattern)


def contains(term: str) -> Column:
    """Cell contains a text, ignoring case; rows without the cell stay."""
    name, text = _named(term)
    return cell(name).isNull() | F.contains(F.lower(cell(name)), F.lit(text.lower()))


def scan(
    df: DataFrame,
    rowkey_regex: str | None = None,
    equal: list[str] | None = None,
    intervals: list[str] | None = None,
    regexes: list[str] | None = None,
    containing: list[str] | None = None,
    columns: list[str] | None = None,
    start: str | None = None,
    stop: str | None = None,
) -> DataFrame:
    """Filtered scan; all conditions must hold. ``start`` is inclusive, ``stop`` exclusive.

    The row-key range reaches the file statistics; cell conditions are evaluated on the map. Cells named in
    ``equal`` and ``regexes`` belong to the projection like ``columns``: as soon as one of the three is given,
    only the cells they name are returned.
    """
    if start is not None:
        df = df.where(F.col("rowkey") >= start)
    if stop is not None:
        df = df.where(F.col("rowkey") < stop)
    if rowkey_regex:
        df = df.where(F.col("rowkey").rlike(rowkey_regex))
    for build, terms in ((equals, equal), (interval, intervals), (matches, regexes), (contains, containing)):
        for term in terms or []:
            df = df.where(build(term))
    named = [*(columns or []), *(_named(t)[0] for t in [*(equal or []), *(regexes or [])])]
    return project(df, named) if named else df


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the listed cells; rows without any of them are not returned."""
    kept = F.map_filter("cols", lambda k, v: k.isin(*columns))
    return df.withColumn("cols", kept).where(F.size("cols") > 0)


def get(df: DataFrame, rowkey: str, columns: list[str] | None = None) -> DataFrame:
    rows = df.where(F.col("rowkey") == rowkey)
    return project(rows, columns) if columns else rows


def multi_get(df: DataFrame, keys: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of a key list ``(rowkey, position)``, with the position; a missing key gives null cells."""
    rows = project(df, columns) if columns else df
    return keys.join(rows, "rowkey", "left").select("position", "rowkey", "cols")


def to_rows(df: DataFrame, rowkey: Column, cells: dict[str, Column]) -> DataFrame:
    """Typed columns to wide-column rows; null columns give no cell."""
    entries = [F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))) for k, v in cells.items()]
    return df.select(rowkey.alias("rowkey"), F.map_from_entries(F.array_compact(F.array(*entries))).alias("cols"))


def put(df: DataFrame, updates: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Upsert cell by cell. ``updates`` has the same columns (and ``order`` if a row key may come twice:
    then the latest value of each cell wins)."""
    # Dealt by row key once: both groupings and the join below use that.
    cells = updates.repartition("rowkey").select("rowkey", *(order or []), F.explode("cols").alias("k", "v"))
    latest = cells.groupBy("rowkey", "k").agg((F.max_by("v", F.struct(*order)) if order else F.max("v")).alias("v"))
    new = latest.groupBy("rowkey").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("__new"))
    merged = F.map_zip_with("cols", "__new", lambda k, old, fresh: F.coalesce(fresh, old))
    both = F.when(F.col("__new").isNull(), F.col("cols")).when(F.col("cols").isNull(), F.col("__new")).otherwise(merged)
    return df.join(new, "rowkey", "full").select("rowkey", both.alias("cols"))


def delete(df: DataFrame, keys: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Delete the rows of ``keys (rowkey)``, or only the listed cells of them."""
    if not columns:
        return df.join(keys.select("rowkey"), "rowkey", "left_anti")
    hit = df.join(keys.select("rowkey", F.lit(True).alias("__hit")).distinct(), "rowkey", "left")
    kept = F.map_filter("cols", lambda k, v: ~k.isin(*columns))
    cols = F.when(F.col("__hit"), kept).otherwise(F.col("cols"))
    return hit.select("rowkey", cols.alias("cols")).where(F.size("cols") > 0)
