"""Sequence patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.operators.patterns import Pattern, match
from brooklet.plans.registry import HOUR, query

ORDER, KEYS = ["event_id"], ["user_id"]
COLUMNS = ["event_id", "event_type", "value", "ts"]
NEXT_SQL = """(SELECT *, epoch_us(ts) // 1000 AS ms, lead(event_id) OVER w AS n_id, lead(event_type) OVER w AS n_type, lead(value) OVER w AS n_value,
    lead(epoch_us(ts) // 1000) OVER w AS n_ms FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""


def is_type(*names):
    return lambda row, *_: row("event_type").isin(*names)


def over(limit, strict=True):
    return lambda row, *_: (row("value") > limit) if strict else (row("value") >= limit)


def _match(t, pattern):
    return match(t.events.select("user_id", *COLUMNS), KEYS, ORDER, "ts", pattern, COLUMNS)


@query(
    "cep_ip_change",
    f"SELECT n_id AS event_id, user_id, n_type AS event_type, event_type AS previous FROM {NEXT_SQL} WHERE n_type <> event_type",
)
def cep_ip_change(t):
    pattern = Pattern.begin("start", lambda r: r("event_type").isNotNull()).next(
        "second", lambda r, s: r("event_type") != s("event_type"), uses_start=True
    )
    rows = _match(t, pattern)
    return rows.select(F.col("second.event_id"), "user_id", F.col("second.event_type"), F.col("start.event_type").alias("previous"))


@query("cep_bounce", f"SELECT user_id, event_id FROM {NEXT_SQL} WHERE event_type = 'view' AND (n_ms IS NULL OR n_ms - ms >= {6 * HOUR})")
def cep_bounce(t):
    pattern = Pattern.begin("start", is_type("view")).next("second", lambda r: r("event_type") != "view").within(6 * HOUR)
    return _match(t, pattern).where("outcome = 'timeout'").select("user_id", "start.event_id")


@query(
    "cep_consecutive_fail",
    f"SELECT user_id, ms AS first_ms, n_ms AS second_ms, CAST(2 AS INTEGER) AS fails FROM {NEXT_SQL} WHERE event_type = 'error' AND n_type = 'error' AND n_ms - ms < {6 * HOUR}",
)
def cep_consecutive_fail(t):
    pattern = Pattern.begin("first", is_type("error")).next("second", is_type("error")).within(6 * HOUR)
    rows = _match(t, pattern).where("outcome = 'matched'")
    at = lambda step: F.unix_millis(F.col(f"{step}.ts").cast("timestamp"))
    return rows.select("user_id", at("first").alias("first_ms"), at("second").alias("second_ms"), F.lit(2).alias("fails"))


@query(
    "cep_triple_hot",
    f"""SELECT user_id, e3 AS event_id, v3 AS value FROM (SELECT user_id, epoch_us(ts) // 1000 AS ms, lead(event_id, 2) OVER w AS e3, lead(value, 2) OVER w AS v3,
          lead(epoch_us(ts) // 1000, 2) OVER w AS ms3 FROM events WHERE value >= 60 WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE ms3 - ms < {72 * HOUR}""",
)
def cep_triple_hot(t):
    hot = over(60, strict=False)
    pattern = Pattern.begin("first", hot).followed_by("second", hot).followed_by("third", hot).within(72 * HOUR)
    return _match(t, pattern).where("outcome = 'matched'").select("user_id", "third.event_id", "third.value")


@query(
    "cep_order_timeout",
    f"""WITH x AS (SELECT *, epoch_us(ts) // 1000 AS ms, min(CASE WHEN event_type = 'purchase' THEN struct_pack(id := event_id, ms := epoch_us(ts) // 1000) END)
                     OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM events)
        SELECT user_id, event_id, CASE WHEN p.ms - ms < {24 * HOUR} THEN 'matched' ELSE 'timeout' END AS outcome, CASE WHEN p.ms - ms < {24 * HOUR} THEN p.id END AS paid_id,
               CASE WHEN NOT coalesce(p.ms - ms < {24 * HOUR}, false) THEN 'timed out: ' || event_id || ', from ' || strftime(ts, '%Y-%m-%d %H:%M:%S') END AS note
        FROM x WHERE event_type = 'view'""",
)
def cep_order_timeout(t):
    pattern = Pattern.begin("created", is_type("view")).followed_by("paid", is_type("purchase")).within(24 * HOUR)
    note = F.concat(F.lit("timed out: "), F.col("created.event_id").cast("string"), F.lit(", from "), F.date_format("created.ts", "yyyy-MM-dd HH:mm:ss"))
    return _match(t, pattern).select(
        "user_id",
        "created.event_id",
        "outcome",
        F.col("paid.event_id").alias("paid_id"),
        F.when(F.col("outcome") == "timeout", note).alias("note"),
    )


@query("cep_hot_pair", f"SELECT user_id, n_id AS event_id, n_value AS value FROM {NEXT_SQL} WHERE value > 30 AND n_value > 30 AND n_ms - ms < {5 * HOUR}")
def cep_hot_pair(t):
    pattern = Pattern.begin("first", over(30)).next("second", over(30)).within(5 * HOUR)
    return _match(t, pattern).where("outcome = 'matched'").select("user_id", "second.event_id", "second.value")


@query(
    "cep_generic",
    f"""WITH x AS (SELECT *, epoch_us(ts) // 1000 AS ms, min(CASE WHEN event_type = 'purchase' THEN struct_pack(id := event_id, ms := epoch_us(ts) // 1000) END)
                     OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM events),
             y AS (SELECT *, lead(event_id) OVER w AS n_id, lead(event_type) OVER w AS n_type, lead(value) OVER w AS n_value, lead(ms) OVER w AS n_ms, lead(p) OVER w AS n_p
                   FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
             z AS (SELECT *, CASE WHEN n_ms IS NULL OR n_ms - ms >= {48 * HOUR} THEN 'timeout' WHEN NOT (n_type IN ('click', 'view') AND n_value > value) THEN 'killed'
                        WHEN n_p IS NULL OR n_p.ms - ms >= {48 * HOUR} THEN 'timeout' ELSE 'matched' END AS outcome,
                     coalesce(n_ms - ms < {48 * HOUR} AND n_type IN ('click', 'view') AND n_value > value, false) AS second_ok FROM y WHERE event_type = 'view')
        SELECT user_id, event_id AS a, CASE WHEN second_ok THEN n_id END AS b, CASE WHEN outcome = 'matched' THEN n_p.id END AS c, outcome FROM z WHERE outcome <> 'killed'""",
)
def cep_generic(t):
    rising = lambda r, s: r("event_type").isin("click", "view") & (r("value") > s("value"))
    pattern = Pattern.begin("a", is_type("view")).next("b", rising, uses_start=True).followed_by("c", is_type("purchase")).within(48 * HOUR)
    rows = _match(t, pattern)
    return rows.select("user_id", F.col("a.event_id").alias("a"), F.col("b.event_id").alias("b"), F.col("c.event_id").alias("c"), "outcome")
