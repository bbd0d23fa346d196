"""Order details completed with their orders.

Two change streams are decoded, details that come after their window has fired are split off, the others
join their order inside the window, and whatever is still open is completed from the order table. Nothing
is dropped: every decoded detail comes out once per order it met in its window, or once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.parsing import cdc_rows
from brooklet.operators.eventtime import split_window_late
from brooklet.operators.joins import lookup

DETAIL = "id long, order_id long, sku long, supplier long, amount int, money double, create_time timestamp"
MAIN = "oid long, create_time timestamp, total_money double, status string, province string"


def decoded_details(details: DataFrame, arrival: list[str], delay_ms: int, size_ms: int, seen_ms: int | None = None) -> DataFrame:
    """Detail rows with their window and ``tag`` (``late`` or ``normal``)."""
    lines = cdc_rows(details, "envelope", DETAIL, keep=tuple(arrival))
    return split_window_late(lines, "create_time", arrival, delay_ms, size_ms, probe=details, seen_ms=seen_ms).withColumnRenamed("type", "change")


def decoded_mains(mains: DataFrame, arrival: list[str], delay_ms: int, size_ms: int, seen_ms: int | None = None) -> DataFrame:
    """Order rows that come in time for their window."""
    heads = cdc_rows(mains, "envelope", MAIN, keep=tuple(arrival))
    return split_window_late(heads, "create_time", arrival, delay_ms, size_ms, probe=mains, seen_ms=seen_ms)


def complete(lines: DataFrame, heads: DataFrame, orders: DataFrame, arrival: list[str]) -> DataFrame:
    """Join details with the orders of their window, and the rest with the order table."""
    # A late detail meets no order in its window: it gets a window number no order has.
    slot = F.when(F.col("tag") == "late", -1 - F.col("w_start")).otherwise(F.col("w_start"))
    lines = lines.withColumn("slot", slot).drop("watermark", "w_start", "w_end", *arrival)
    found = heads.select(
        F.col("oid").alias("order_id"),
        F.col("w_start").alias("slot"),
        F.struct("total_money", "status", "province").alias("met"),
    )
    # One order per key and window (a few at most), so AQE's skew split of the detail side is all a hot order needs.
    joined = lines.join(found, ["order_id", "slot"], "left")
    via = F.when(F.col("met").isNotNull(), F.lit("window")).when(F.col("tag") == "late", F.lit("late")).otherwise(F.lit("miss"))
    table = orders.select("oid", F.struct("total_money", "status", "province").alias("known"))
    done = lookup(joined.withColumn("via", via).drop("slot", "tag"), table, {"order_id": "oid"})
    order = F.coalesce("met", "known")
    return done.select(
        *[c for c in lines.columns if c not in ("slot", "tag")],
        "via",
        order["total_money"].alias("total_money"),
        order["status"].alias("status"),
        order["province"].alias("province"),
    )


def enrich_orders(
    details: DataFrame,
    mains: DataFrame,
    orders: DataFrame,
    detail_arrival: list[str],
    main_arrival: list[str],
    delay_ms: int = 2000,
    size_ms: int = 5000,
) -> DataFrame:
    """``details`` and ``mains`` hold an ``envelope`` and their arrival columns; ``orders`` is the lookup
    table ``(oid, total_money, status, province)``.

    The result has the detail columns, ``via`` (``window``, ``miss`` or ``late``) and the order's columns.
    """
    lines = decoded_details(details, detail_arrival, delay_ms, size_ms)
    heads = decoded_mains(mains, main_arrival, delay_ms, size_ms).where("tag = 'normal'")
    return complete(lines, heads, orders, detail_arrival)
