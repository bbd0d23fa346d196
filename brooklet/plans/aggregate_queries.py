"""Final and running aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.functions import parsing
from brooklet.operators import aggregates as agg
from brooklet.operators.ordered import Min, Sum
from brooklet.plans.registry import query
from brooklet.plans.scalar_queries import WORDS_SQL

ORDER = ["event_id"]


@query("agg_word_count", f"SELECT word, count(*) AS n FROM (SELECT {WORDS_SQL.format('text')} AS word FROM documents) GROUP BY 1")
def agg_word_count(t):
    return agg.count_by(parsing.words(t.documents, "text"), ["word"])


@query("agg_running_sum", "SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS total FROM events")
def agg_running_sum(t):
    rows = agg.running(t.events.select("event_id", "user_id", "value"), ["user_id"], ORDER, total=Sum("value"))
    return rows.select("event_id", "user_id", F.round("total", 4).alias("total"))


RUNNING_SQL = """(SELECT event_id, user_id, CASE WHEN row_number() OVER w = 1 THEN event_type ELSE 'total' END AS event_type,
    sum(k) OVER w AS k FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""


def _keyed(t):
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    return t.events.select("event_id", "user_id", "event_type", k)


@query("agg_running_reduce", f"SELECT event_id, user_id, event_type, CAST(k AS BIGINT) AS k FROM {RUNNING_SQL}")
def agg_running_reduce(t):
    return agg.running_reduce(_keyed(t), ["user_id"], ORDER, "k", "event_type", "total")


@query("agg_running_min_reduce", "SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, min(value) OVER (PARTITION BY user_id ORDER BY event_id) AS low FROM events")
def agg_running_min_reduce(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).alias("ms")
    rows = agg.running(t.events.select("event_id", "user_id", ms, "value"), ["user_id"], ORDER, low=Min("value"))
    return rows.drop("value")


def _best_sql(how: str, source: str, by: str, cols: str) -> str:
    fn, sign = ("max", "-") if how == "max" else ("min", "")
    pick = ", ".join(f"b.{c} AS best_{c}" for c in cols.split(", "))
    return f"""SELECT event_id, user_id, {pick} FROM (SELECT event_id, user_id,
        {fn}(struct_pack(v := {by}, o := {sign}event_id, {', '.join(f'{c} := {c}' for c in cols.split(', '))})) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM {source})"""


@query("agg_running_max_by", _best_sql("max", "events", "value", "event_type, value"))
def agg_running_max_by(t):
    rows = agg.running_best(t.events, ["user_id"], ORDER, "value", "max", ["event_type", "value"])
    return rows.select("event_id", "user_id", "best_event_type", "best_value")


@query("agg_running_min_by", _best_sql("min", "events", "value", "event_type, value"))
def agg_running_min_by(t):
    rows = agg.running_best(t.events, ["user_id"], ORDER, "value", "min", ["event_type", "value"])
    return rows.select("event_id", "user_id", "best_event_type", "best_value")


@query(
    "agg_final_max_by",
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1",
)
def agg_final_max_by(t):
    return agg.final_best(t.events, ["user_id"], ORDER, "value", "max", ["event_id", "event_type", "value"])


@query("agg_chain_reduce_maxby", _best_sql("max", RUNNING_SQL, "k", "event_type, k").replace("b.k AS", "CAST(b.k AS BIGINT) AS"))
def agg_chain_reduce_maxby(t):
    rows = agg.reduce_then_best(_keyed(t), ["user_id"], ORDER, "k", "event_type", "total")
    return rows.select("event_id", "user_id", "best_event_type", "best_k")


@query("agg_custom_acc", "SELECT user_id, round(sum(value), 2) / count(value) AS mean FROM events GROUP BY 1")
def agg_custom_acc(t):
    return t.events.groupBy("user_id").agg((F.round(F.sum("value"), 2) / F.count("value")).alias("mean"))


@query("agg_udaf_sum", "SELECT p_brand, round(sum(p_retailprice), 4) AS total FROM part GROUP BY 1")
def agg_udaf_sum(t):
    return t.part.groupBy("p_brand").agg(F.round(F.sum("p_retailprice"), 4).alias("total"))


@query("agg_top2", "SELECT o_totalprice AS v, CAST(row_number() OVER (ORDER BY o_totalprice DESC) AS INTEGER) AS rank FROM orders QUALIFY rank <= 2")
def agg_top2(t):
    return agg.top_n(t.orders.select(F.col("o_totalprice").alias("v")), "v", 2)


@query(
    "agg_top2_keyed",
    "SELECT user_id, value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS INTEGER) AS rank FROM events QUALIFY rank <= 2",
)
def agg_top2_keyed(t):
    return agg.top_n(t.events.select("user_id", "value"), "value", 2, ["user_id"])


@query(
    "agg_distinct_running",
    """WITH f AS (SELECT *, row_number() OVER (PARTITION BY event_type, k, user_id ORDER BY event_id) = 1 AS fresh
                  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS k FROM events))
       SELECT event_id, event_type, k, CAST(sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER w AS BIGINT) AS users, count(*) OVER w AS clicks
       FROM f WINDOW w AS (PARTITION BY event_type, k ORDER BY event_id)""",
)
def agg_distinct_running(t):
    rows = t.events.select("event_id", "event_type", (F.get_json_object("props", "$.k").cast("long") % 3).alias("k"), "user_id")
    return agg.running_distinct(rows, ["event_type", "k"], "user_id", ORDER).drop("user_id")


@query(
    "agg_lag_report",
    """WITH e AS (SELECT event_type AS topic, user_id % 8 AS p, max(event_id) + 1 AS e FROM events GROUP BY 1, 2),
            c AS (SELECT 'g' || (event_id % 3) AS "group", event_type AS topic, user_id % 8 AS p, max(event_id) AS c FROM events
                  WHERE NOT (event_type = 'view' AND user_id % 8 = 5) AND NOT (event_type = 'click' AND event_id % 3 = 1) GROUP BY 1, 2, 3
                  UNION ALL SELECT 'g2', 'purchase', 8, 17),
            j AS (SELECT "group", topic, bool_or(e IS NULL OR c IS NULL) AS lost, sum(e - c) AS lag
                  FROM (SELECT * FROM e, (SELECT DISTINCT "group" FROM c)) FULL JOIN c USING ("group", topic, p) GROUP BY 1, 2)
       SELECT "group", topic, CASE WHEN NOT lost THEN CAST(lag AS BIGINT) END AS lag, CASE WHEN lost THEN 'lost' ELSE 'ok' END AS status FROM j""",
)
def agg_lag_report(t):
    part = (F.col("user_id") % 8).alias("partition")
    ends = t.events.groupBy(F.col("event_type").alias("topic"), part).agg((F.max("event_id") + 1).alias("end_offset"))
    # One partition nobody committed, one topic a group never read, one partition that is gone.
    seen = t.events.where(~((F.col("event_type") == "view") & (F.col("user_id") % 8 == 5)))
    seen = seen.where(~((F.col("event_type") == "click") & (F.col("event_id") % 3 == 1)))
    group = F.concat(F.lit("g"), (F.col("event_id") % 3).cast("string")).alias("group")
    committed = seen.groupBy(group, F.col("event_type").alias("topic"), part).agg(F.max("event_id").alias("committed"))
    gone = t.spark.range(1).selectExpr("'g2' AS `group`", "'purchase' AS topic", "8L AS partition", "17L AS committed")
    return agg.lag_report(ends, committed.unionByName(gone))
