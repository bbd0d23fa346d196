"""Keyed state, timers and recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.operators import machines, stateful
from brooklet.plans.registry import HOUR, query, use_rocksdb
from brooklet.streaming.exactly_once import batch_files, latest_state, read_batches, write_stream

ORDER = ["event_id"]
EVENT_MS_SQL = "(SELECT *, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)"


@query(
    "st_running_count_parity",
    "SELECT event_id, user_id, total, CASE WHEN total % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS total FROM events)",
)
def st_running_count_parity(t):
    return stateful.running_parity(t.events.select("event_id", "user_id"), ["user_id"], ORDER)


@query("st_value_sum", "SELECT event_id, user_id, value AS total FROM events")
def st_value_sum(t):
    return stateful.value_sum(t.events, "value").select("event_id", "user_id", "total")


@query(
    "st_history_list",
    "SELECT event_id, string_agg(CAST(event_id AS VARCHAR), ' ') OVER (PARTITION BY user_id ORDER BY event_id) AS history FROM events",
)
def st_history_list(t):
    rows = stateful.history_list(t.events.select("event_id", "user_id"), ["user_id"], ORDER, "event_id")
    return rows.select("event_id", F.array_join(F.transform("history", lambda v: v.cast("string")), " ").alias("history"))


@query(
    "st_delimited_segments",
    """WITH m AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id) AS segment,
                    count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id) AS closed FROM events)
       SELECT user_id, segment, count(*) AS n, string_agg(event_type, ' ' ORDER BY event_id) AS text FROM m WHERE event_type <> 'signup' AND segment < closed GROUP BY 1, 2""",
)
def st_delimited_segments(t):
    return stateful.delimited_segments(t.events, ["user_id"], ORDER, "event_type", F.col("event_type") == "signup")


@query(
    "st_ip_change",
    "SELECT event_id, user_id, event_type, previous FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events) WHERE previous <> event_type",
)
def st_ip_change(t):
    return stateful.changed_value(t.events.select("event_id", "user_id", "event_type"), ["user_id"], ORDER, "event_type")


@query(
    "st_inactivity_timeout",
    f"""SELECT event_id, user_id, rn AS total, ms + {10 * HOUR} AS fired_ms FROM (SELECT *, lead(ms) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM {EVENT_MS_SQL})
        WHERE nxt IS NULL OR nxt - ms >= {10 * HOUR}""",
)
def st_inactivity_timeout(t):
    rows = stateful.inactivity(t.events.select("event_id", "user_id", "ts"), ["user_id"], ORDER, "ts", 10 * HOUR)
    return rows.drop("ts")


@query(
    "st_rising_alert",
    f"""WITH RECURSIVE e AS {EVENT_MS_SQL},
        st AS (SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS DOUBLE) AS last, CAST(NULL AS BIGINT) AS timer, CAST(NULL AS BIGINT) AS f_at, CAST(NULL AS DOUBLE) AS f_value
               FROM (SELECT DISTINCT user_id FROM e)
          UNION ALL
          SELECT user_id, rn, value, CASE WHEN value > last AND t1 IS NULL THEN ms + {10 * HOUR} WHEN value < last THEN NULL ELSE t1 END, due, CASE WHEN due IS NOT NULL THEN last END
          FROM (SELECT *, CASE WHEN due IS NULL THEN timer END AS t1 FROM (
                  SELECT st.user_id, e.rn, e.ms, e.value, st.last, st.timer, CASE WHEN st.timer <= e.ms THEN st.timer END AS due
                  FROM st JOIN e ON e.user_id = st.user_id AND e.rn = st.rn + 1)))
        SELECT user_id, f_at AS at_ms, f_value AS value FROM st WHERE f_at IS NOT NULL
        UNION ALL SELECT user_id, timer, last FROM st WHERE timer IS NOT NULL AND rn = (SELECT max(rn) FROM e WHERE e.user_id = st.user_id)""",
)
def st_rising_alert(t):
    return machines.rising_alert(t.events, ["user_id"], ORDER, "ts", "value", 10 * HOUR)


@query("st_timer_echo", f"SELECT event_id, 'value' AS kind, ms AS at_ms FROM {EVENT_MS_SQL} UNION ALL SELECT event_id, 'timer', ms + {2 * HOUR} FROM {EVENT_MS_SQL}")
def st_timer_echo(t):
    return stateful.timer_echo(t.events, "ts", 2 * HOUR).select("event_id", "kind", "at_ms")


@query(
    "st_login_fail_timer",
    f"""WITH RECURSIVE e AS (SELECT user_id, event_type = 'error' AS failed, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
                             FROM events WHERE event_type IN ('error', 'signup')),
        st AS (SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS fails, CAST(NULL AS BIGINT) AS timer, CAST(NULL AS BIGINT) AS f_at, CAST(NULL AS BIGINT) AS f_n
               FROM (SELECT DISTINCT user_id FROM e)
          UNION ALL
          SELECT user_id, rn, CASE WHEN failed THEN f1 + 1 ELSE 0 END, CASE WHEN failed THEN coalesce(t1, ms + {24 * HOUR}) END, due, CASE WHEN due IS NOT NULL THEN fails END
          FROM (SELECT *, CASE WHEN due IS NULL THEN timer END AS t1, CASE WHEN due IS NULL THEN fails ELSE 0 END AS f1 FROM (
                  SELECT st.user_id, e.rn, e.ms, e.failed, st.fails, st.timer, CASE WHEN st.timer < e.ms THEN st.timer END AS due
                  FROM st JOIN e ON e.user_id = st.user_id AND e.rn = st.rn + 1)))
        SELECT user_id, f_at AS at_ms, f_n AS fails FROM st WHERE f_n >= 2
        UNION ALL SELECT user_id, timer, fails FROM st WHERE timer IS NOT NULL AND fails >= 2 AND rn = (SELECT max(rn) FROM e WHERE e.user_id = st.user_id)""",
)
def st_login_fail_timer(t):
    is_type = lambda name: F.col("event_type") == name
    return machines.fail_burst(t.events, ["user_id"], ORDER, "ts", is_type("error"), is_type("signup"), 24 * HOUR)


@query("st_recovery", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def st_recovery(t):
    """A stateful stream that is stopped half way and restarted from its checkpoint."""
    use_rocksdb(t.spark)
    watched, out = t.fresh_path("recovery-in"), t.fresh_path("recovery")
    rows = t.events.select("event_id", "user_id", "value")
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).write.mode("append").parquet(watched)
        stream = t.spark.readStream.schema(rows.schema).parquet(watched)
        totals = stream.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        write_stream(totals, batch_files(out + "/rows"), out + "/checkpoint", mode="update").awaitTermination()
    return latest_state(read_batches(t.spark, out + "/rows"), ["user_id"], ["n", "total"])
