"""The flagship as one streaming query: details and orders in, completed details out.

Both change streams arrive in one query. Details later than their window leave at once by the order table; the others,
and the orders, are held until the watermarks of both streams have passed their window, are joined there, and what
meets no order takes the same way as the late ones. The result is that of ``plans.order_enrich.enrich_orders``, row
for row, however the streams are cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.scalars import epoch_ms
from brooklet.plans.order_enrich import complete, decoded_details, decoded_mains
from brooklet.session import saved
from brooklet.streaming.held import Held

Sink = Callable[[DataFrame, int], None]
_SIDES = ("detail", "main")


def both_streams(details: DataFrame, mains: DataFrame) -> DataFrame:
    """Both change streams in one, told apart by ``side``."""
    return details.withColumn("side", F.lit("detail")).unionByName(mains.withColumn("side", F.lit("main")), allowMissingColumns=True)


def enrich_orders_stream(
    orders: Callable[[], DataFrame], detail_arrival: list[str], main_arrival: list[str], folder: str, sink: Sink, delay_ms: int = 2000, size_ms: int = 5000
) -> Sink:
    """A ``foreachBatch`` function for ``both_streams``. Rows of a stream arrive in the order of its arrival columns.
    ``orders`` gives the order table as it is at the moment; open windows are held under ``folder``."""
    marks = Held(f"{folder}/marks", T.StructType.fromDDL("side string, seen long"))
    open_: dict[str, Held] = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = {r["side"]: r["seen"] for r in marks.before(spark, batch_id).collect()}
        arrivals = {"detail": detail_arrival, "main": main_arrival}
        decode = {"detail": decoded_details, "main": decoded_mains}
        rows = {}
        for side in _SIDES:
            own = batch.where(F.col("side") == side).select("envelope", *arrivals[side])
            rows[side] = saved(decode[side](own, arrivals[side], delay_ms, size_ms, seen.get(side)), f"enrich-{side}")
            top = rows[side].agg(F.max(epoch_ms(F.col("create_time")))).first()[0]
            if top is not None:
                seen[side] = max(top, seen.get(side, top))
            open_.setdefault(side, Held(f"{folder}/{side}", rows[side].schema))
        # The window [s, e) is over for both streams once both watermarks have reached e - 1.
        mark = min(seen.values()) - delay_ms - 1 if len(seen) == len(_SIDES) else None
        over = F.lit(False) if mark is None else F.col("w_end") - 1 <= mark
        ready = {}
        for side in _SIDES:
            pending = open_[side].before(spark, batch_id).unionByName(rows[side].where("tag = 'normal'"))
            open_[side].write(pending.where(~over), batch_id)
            ready[side] = pending.where(over)
        lines = ready["detail"].unionByName(rows["detail"].where("tag = 'late'"))
        sink(complete(lines, ready["main"], orders(), detail_arrival), batch_id)
        marks.write(spark.createDataFrame(list(seen.items()), marks.schema), batch_id)

    return run
