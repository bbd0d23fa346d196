"""User functions in each kind, registered and inline."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from brooklet.functions import udfs
from brooklet.operators import aggregates, windows
from brooklet.plans.registry import HOUR, query
from brooklet.plans.window_queries import windowed

LENGTH_SQL = "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents"
FIELDS_SQL = "SELECT p_partkey, field, CAST(length(field) AS INTEGER) AS length FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS field FROM part) WHERE field <> ''"
ORDER = ["event_id"]


@query("udf_scalar_inline", LENGTH_SQL)
def udf_scalar_inline(t):
    return t.documents.select("doc_id", udfs.text_length("text").alias("n"))


@query("udf_scalar_registered", LENGTH_SQL)
def udf_scalar_registered(t):
    udfs.register_all(t.spark)
    t.documents.createOrReplaceTempView("documents_view")
    return t.spark.sql("SELECT doc_id, text_length(text) AS n FROM documents_view")


@query("udtf_inline", FIELDS_SQL)
def udtf_inline(t):
    return t.part.lateralJoin(udfs.FieldLengths(F.col("p_name").outer())).select("p_partkey", "field", "length")


@query("udtf_registered", FIELDS_SQL)
def udtf_registered(t):
    udfs.register_all(t.spark)
    t.part.createOrReplaceTempView("part_view")
    return t.spark.sql("SELECT p_partkey, f.field, f.length FROM part_view, LATERAL field_lengths(p_name) f")


@query("udaf_registered", "SELECT p_brand, round(sum(p_retailprice), 4) AS total FROM part GROUP BY 1")
def udaf_registered(t):
    """A Python aggregate gets whole groups, so it runs on blocks of keys first and then on the block totals."""
    udfs.register_all(t.spark)
    t.part.createOrReplaceTempView("part_view")
    return t.spark.sql(
        """SELECT p_brand, round(price_total(part_total), 4) AS total
           FROM (SELECT p_brand, price_total(p_retailprice) AS part_total FROM part_view GROUP BY p_brand, p_partkey DIV 100000)
           GROUP BY p_brand"""
    )


@query(
    "udtaf",
    "SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rank FROM events QUALIFY rank <= 2",
)
def udtaf(t):
    def two_largest(pdf: pd.DataFrame) -> pd.DataFrame:
        top = pdf.sort_values("value", ascending=False, kind="stable").groupby("user_id", sort=False).head(2)
        return top.assign(rank=top.groupby("user_id", sort=False).cumcount() + 1)

    rows = t.events.select("user_id", "value", F.lit(0).cast("long").alias("rank"))
    return udfs.table_aggregate(rows, ["user_id"], two_largest, "user_id long, value double, rank long")


@query("fn_rich", "SELECT event_id, CASE event_type WHEN 'error' THEN 'bad' WHEN 'purchase' THEN 'paid' ELSE 'seen' END AS label FROM events")
def fn_rich(t):
    def opener() -> dict[str, str]:
        return {"error": "bad", "purchase": "paid"}

    def label(table: dict[str, str], pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_id": pdf["event_id"], "label": pdf["event_type"].map(table).fillna("seen")})

    return udfs.with_resource(t.events.select("event_id", "event_type"), opener, label, "event_id long, label string", dict.clear)


@query("fn_reduce", "SELECT event_id, event_type, round(sum(value) OVER (PARTITION BY event_type ORDER BY event_id), 4) AS value FROM events")
def fn_reduce(t):
    rows = t.events.select("event_id", "event_type", F.lit("raw").alias("mark"), "value")
    reduced = aggregates.running_reduce(rows, ["event_type"], ORDER, "value", "mark", "total")
    return reduced.select("event_id", "event_type", F.round("value", 4).alias("value"))


@query("fn_aggregate", "SELECT event_type, count(value) AS n, round(sum(value), 2) / count(value) AS mean FROM events GROUP BY 1")
def fn_aggregate(t):
    return t.events.groupBy("event_type").agg(F.count("value").alias("n"), (F.round(F.sum("value"), 2) / F.count("value")).alias("mean"))


@query("fn_window", f"SELECT user_id, w_start, w_end, round(max(value), 4) AS high FROM {windowed(6 * HOUR)} GROUP BY ALL")
def fn_window(t):
    return windows.with_window(t.events, "ts", 6 * HOUR).groupBy("user_id", "w_start", "w_end").agg(F.round(F.max("value"), 4).alias("high"))


@query(
    "fn_process_window",
    f"""SELECT event_type, w_start, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY w_start) AS BIGINT) AS total
        FROM (SELECT event_type, w_start, count(*) AS n FROM {windowed(HOUR)} GROUP BY 1, 2)""",
)
def fn_process_window(t):
    return windows.cumulative(t.events, "ts", HOUR, ["event_type"]).drop("w_end")
