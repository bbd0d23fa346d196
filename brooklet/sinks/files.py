"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def row_text(columns: list[str], name: str = "") -> Column:
    """A row as ``name(a,b,c)``; nulls print as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.concat(F.lit(name + "("), F.concat_ws(",", *parts), F.lit(")"))


def write_rows(df: DataFrame, path: str, name: str = "", mode: str = "errorifexists") -> None:
    """One text line per row (UTF-8)."""
    df.select(row_text(df.columns, name).alias("value")).write.mode(mode).text(path)


def stream_rows(df: DataFrame, path: str, checkpoint: str, name: str = "", **trigger) -> StreamingQuery:
    """The same on a stream; the checkpoint makes the files exactly-once."""
    lines = df.select(row_text(df.columns, name).alias("value"))
    writer = lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_csv_table(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", mode: str = "errorifexists") -> None:
    df.select(*(columns or df.columns)).write.mode(mode).csv(path, sep=sep)
