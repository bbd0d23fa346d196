"""Time, count and row windows, watermarks and late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms, from_epoch, range_label
from brooklet.operators import eventtime as et
from brooklet.operators import windows as win
from brooklet.operators.ordered import Sum
from brooklet.plans.registry import DAY, HOUR, SQL_EVENTS, query

ORDER = ["event_id"]
ARRIVALS = ["arrival", "event_id"]
DELAY = 30 * 60 * 1000


def windowed(size: int) -> str:
    return f"(SELECT *, ms - ms % {size} AS w_start, ms - ms % {size} + {size} AS w_end FROM {SQL_EVENTS})"


def watermarked(size: int = HOUR, delay: int = DELAY) -> str:
    return f"""(SELECT *, max(ms) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} - 1 AS wm
        FROM {windowed(size)})"""


@query(
    "win_tumble_sum",
    f"SELECT user_id, make_timestamp(w_start * 1000) AS window_start, make_timestamp(w_end * 1000) AS window_end, round(sum(value), 4) AS total FROM {windowed(HOUR)} GROUP BY ALL",
)
def win_tumble_sum(t):
    return win.tumble(t.events, "ts", "1 hour", ["user_id"], F.round(F.sum("value"), 4).alias("total"))


@query("win_tumble_min_reduce", f"SELECT user_id, w_start, max(ms) AS last_ms, min(value) AS low FROM {windowed(6 * HOUR)} GROUP BY 1, 2")
def win_tumble_min_reduce(t):
    rows = win.with_window(t.events, "ts", 6 * HOUR).groupBy("user_id", "w_start")
    return rows.agg(F.max_by(epoch_ms(F.col("ts")), "event_id").alias("last_ms"), F.min("value").alias("low"))


@query(
    "win_tumble_apply",
    f"SELECT event_type, w_start || '--' || w_end AS span, round(sum(value), 4) AS total FROM {windowed(HOUR)} GROUP BY event_type, w_start, w_end",
)
def win_tumble_apply(t):
    rows = win.with_window(t.events, "ts", HOUR).groupBy("event_type", "w_start", "w_end").agg(F.round(F.sum("value"), 4).alias("total"))
    return rows.select("event_type", range_label(F.col("w_start"), F.col("w_end")).alias("span"), "total")


@query(
    "win_tumble_acc_string",
    f"SELECT event_type || ',' || max(ms) || ',' || sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS text FROM {windowed(HOUR)} GROUP BY event_type, w_start",
)
def win_tumble_acc_string(t):
    return win.labelled_sum(t.events, "ts", HOUR, "event_type", F.get_json_object("props", "$.k").cast("long")).select("text")


@query(
    "win_tumble_table",
    f"SELECT event_type, make_timestamp(w_start * 1000) AS window_start, make_timestamp(w_end * 1000) AS window_end, count(*) AS n, round(sum(value), 2) / count(value) AS mean FROM {windowed(HOUR)} GROUP BY ALL",
)
def win_tumble_table(t):
    return win.tumble(t.events, "ts", "1 hour", ["event_type"], F.count("*").alias("n"), (F.round(F.sum("value"), 2) / F.count("value")).alias("mean"))


@query(
    "win_tumble_event_sum",
    f"SELECT event_type, w_start, round(sum(value), 4) AS total FROM {watermarked()} WHERE coalesce(w_end - 1 > wm, true) GROUP BY 1, 2",
)
def win_tumble_event_sum(t):
    rows = et.split_window_late(t.arrivals, "ts", ARRIVALS, DELAY, HOUR).where("tag = 'normal'")
    return rows.groupBy("event_type", "w_start").agg(F.round(F.sum("value"), 4).alias("total"))


@query("win_all_tumble", f"SELECT w_start, w_end, count(*) AS n, round(sum(value), 4) AS total FROM {windowed(HOUR)} GROUP BY 1, 2")
def win_all_tumble(t):
    rows = win.with_window(t.events, "ts", HOUR).groupBy("w_start", "w_end")
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "win_count_sliding",
    """SELECT user_id, rn AS fire, mean FROM (SELECT user_id, row_number() OVER w AS rn,
       round(sum(value) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 2) / least(rn, 10) AS mean FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE rn % 2 = 0""",
)
def win_count_sliding(t):
    rows = t.events.select("user_id", "event_id", "value")
    partial = {"s": F.sum("value"), "c": F.count("value")}
    return win.count_slide_partials(rows, ["user_id"], ORDER, 10, 2, partial, {"mean": F.round(F.sum("s"), 2) / F.sum("c")})


@query(
    "win_over_rows",
    """SELECT event_id, user_id, count(*) OVER w AS n, round(avg(value) OVER w, 4) AS mean FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def win_over_rows(t):
    rows = win.over_rows(t.events.select("user_id", "event_id", "value"), ["user_id"], ORDER, 2, "value")
    return rows.select("event_id", "user_id", "n", F.round("mean", 4).alias("mean"))


@query(
    "win_state_cumulative",
    f"""SELECT user_id, w_start, w_end, n, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY w_start) AS BIGINT) AS total
        FROM (SELECT user_id, w_start, w_end, count(*) AS n FROM {windowed(6 * HOUR)} GROUP BY ALL)""",
)
def win_state_cumulative(t):
    return win.cumulative(t.events, "ts", 6 * HOUR, ["user_id"])


@query("win_state_per_row_total", f"SELECT event_id, user_id, w_start, w_end, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM {windowed(6 * HOUR)}")
def win_state_per_row_total(t):
    return win.per_row_total(t.events.select("event_id", "user_id", "ts"), "ts", 6 * HOUR, ["user_id"], ORDER).drop("ts")


@query("win_state_stuck_total", f"SELECT event_id, user_id, w_start, w_end, dense_rank() OVER (PARTITION BY user_id ORDER BY w_start) AS total FROM {windowed(6 * HOUR)}")
def win_state_stuck_total(t):
    return win.stuck_total(t.events.select("event_id", "user_id", "ts"), "ts", 6 * HOUR, ["user_id"], ORDER).drop("ts")


@query(
    "win_state_list",
    f"""SELECT DISTINCT 'key:' || user_id || ',time:' || w_start || '--' || w_end AS label,
          string_agg(CAST(event_id AS VARCHAR), ' ' ORDER BY event_id) OVER (PARTITION BY user_id ORDER BY w_start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS history
        FROM {windowed(DAY)}""",
)
def win_state_list(t):
    rows = win.value_list(t.events, "ts", DAY, ["user_id"], ORDER, "event_id")
    label = F.format_string("key:%s,time:%s", "user_id", range_label(F.col("w_start"), F.col("w_end")))
    return rows.select(label.alias("label"), F.array_join(F.transform("history", lambda v: v.cast("string")), " ").alias("history"))


@query(
    "win_state_updown",
    f"""SELECT user_id, w_start, w_end, CAST(sum(up) OVER w AS BIGINT) AS up, CAST(sum(down) OVER w AS BIGINT) AS down FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w_start) AS i FROM (
            SELECT user_id, w_start, w_end, count(*) FILTER (value > 5.0) AS up, count(*) FILTER (value <= 5.0) AS down FROM {windowed(6 * HOUR)} GROUP BY ALL))
        WHERE i > 1 WINDOW w AS (PARTITION BY user_id ORDER BY w_start)""",
)
def win_state_updown(t):
    return win.up_down(t.events, "ts", 6 * HOUR, ["user_id"], "value", 5.0)


@query("win_late_side_output", f"SELECT event_id, w_start, CASE WHEN w_end - 1 <= wm THEN 'late' ELSE 'normal' END AS tag FROM {watermarked()}")
def win_late_side_output(t):
    return et.split_window_late(t.arrivals, "ts", ARRIVALS, DELAY, HOUR).select("event_id", "w_start", "tag")


@query(
    "win_allowed_lateness",
    f"""WITH x AS (SELECT event_id, arrival, event_type, w_start, value, coalesce(w_end - 1 <= wm, false) AS late,
                     coalesce(w_end - 1 + {HOUR} <= wm, false) AS gone FROM {watermarked()}),
             r AS (SELECT *, count(*) OVER w AS n, sum(value) OVER w AS total, lead(late) OVER w AS nxt FROM x WHERE NOT gone
                   WINDOW w AS (PARTITION BY event_type, w_start ORDER BY arrival, event_id))
        SELECT event_id, event_type, w_start, n, round(total, 4) AS total, CASE WHEN late THEN 'update' ELSE 'fire' END AS tag FROM r WHERE late OR coalesce(nxt, true)
        UNION ALL SELECT event_id, event_type, w_start, NULL, NULL, 'late' FROM x WHERE gone""",
)
def win_allowed_lateness(t):
    rows = et.tumble_with_lateness(t.arrivals, "ts", ARRIVALS, DELAY, HOUR, HOUR, ["event_type"], "value")
    return rows.select("event_id", "event_type", "w_start", "n", F.round("total", 4).alias("total"), "tag")


@query("late_split_record", f"SELECT event_id, CASE WHEN ms < wm THEN 'late' ELSE 'normal' END AS tag FROM {watermarked()}")
def late_split_record(t):
    return et.split_late(t.arrivals, "ts", ARRIVALS, DELAY).select("event_id", "tag")


# Times cut to whole half hours, so that some rows do sit on the last tick of a window.
HALF_HOUR_SQL = f"""(SELECT event_id, event_id + CASE WHEN event_id % 10 = 0 THEN 40 ELSE 0 END AS arrival,
    epoch_us(ts) // 1000 - epoch_us(ts) // 1000 % {DELAY} + CASE WHEN event_id % 3 = 0 THEN {DELAY} - 1 ELSE 0 END AS ms FROM events)"""


@query(
    "late_split_in_window",
    f"""WITH x AS (SELECT *, ms - ms % {HOUR} + {HOUR} AS w_end, max(ms) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY} - 1 AS wm,
                     max(ms) OVER (ORDER BY arrival, event_id) - {DELAY} - 1 AS after FROM {HALF_HOUR_SQL})
        SELECT event_id, w_end, CASE WHEN ms = w_end - 1 AND w_end IN (SELECT after + 1 FROM x) THEN 'normal' ELSE 'late' END AS tag
        FROM x WHERE coalesce(w_end - 1 > wm, true)""",
)
def late_split_in_window(t):
    ms = epoch_ms(F.col("ts"))
    tick = F.when(F.col("event_id") % 3 == 0, F.lit(DELAY - 1)).otherwise(F.lit(0))
    rows = t.arrivals.select("event_id", "arrival", F.timestamp_millis(ms - ms % DELAY + tick).alias("at"))
    return et.split_late_at_fire(rows, "at", ARRIVALS, DELAY, HOUR).select("event_id", "w_end", "tag")


@query("wm_monotonous", "SELECT event_id, max(epoch_us(ts) // 1000) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS watermark FROM events")
def wm_monotonous(t):
    return et.replay_watermark(t.events, "ts", ORDER).select("event_id", "watermark")


@query("wm_bounded", f"SELECT event_id, wm AS watermark FROM {watermarked()}")
def wm_bounded(t):
    return et.replay_watermark(t.arrivals, "ts", ARRIVALS, DELAY).select("event_id", "watermark")


@query("wm_none", f"SELECT event_id, arrival AS stamped, CAST(NULL AS BIGINT) AS watermark FROM {SQL_EVENTS}")
def wm_none(t):
    """Rows stamped on arrival; without a watermark nothing is ever late."""
    return t.arrivals.select("event_id", F.col("arrival").alias("stamped"), F.lit(None).cast("long").alias("watermark"))


@query("ts_unit_scale", "SELECT event_id, make_timestamp((epoch_us(ts) // 1000 // 1000) * 1000000) AS from_s, make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_ms FROM events")
def ts_unit_scale(t):
    ms = epoch_ms(F.col("ts"))
    seconds, millis = from_epoch(F.floor(ms / 1000), "s"), from_epoch(ms, "ms")
    return t.events.select("event_id", seconds.cast("timestamp_ntz").alias("from_s"), millis.cast("timestamp_ntz").alias("from_ms"))


@query("tbl_proctime", f"SELECT event_id, user_id, arrival AS proc_time FROM {SQL_EVENTS}")
def tbl_proctime(t):
    return t.arrivals.select("event_id", "user_id", F.col("arrival").alias("proc_time"))


@query("tbl_rowtime", "SELECT event_id, user_id, ts AS row_time FROM events")
def tbl_rowtime(t):
    return t.events.select("event_id", "user_id", F.col("ts").alias("row_time"))


@query("win_state_value_total", f"SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY event_id), 4) AS total FROM {windowed(DAY)}")
def win_state_value_total(t):
    rows = t.events.select("event_id", "event_type", "ts", "value")
    return win.per_row_total(rows, "ts", DAY, ["event_type"], ORDER, Sum("value")).select("event_id", F.round("total", 4).alias("total"))
