"""Window joins, lookups, lateral joins, two-stream sums, control streams and the order flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.functions.udfs import field_lengths
from brooklet.operators import joins, machines, pairs, rules
from brooklet.plans.order_enrich import enrich_orders
from brooklet.plans.registry import DAY, HOUR, query

HALF_DAY = 12 * HOUR


def side(t, event_type: str, prefix: str):
    return t.events.where(F.col("event_type") == event_type).select(
        "user_id",
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("value").alias(f"{prefix}_value"),
        F.col("ts").alias(f"{prefix}_ts"),
    )


def side_sql(event_type: str, prefix: str, size: int = DAY) -> str:
    return f"""(SELECT user_id, event_id AS {prefix}_id, value AS {prefix}_value, epoch_us(ts) // 1000 AS {prefix}_ms,
        (epoch_us(ts) // 1000) // {size} AS w FROM events WHERE event_type = '{event_type}')"""


@query(
    "join_window_inner",
    f"SELECT user_id, l_value, r_value, l_ms, r_ms FROM {side_sql('view', 'l')} JOIN {side_sql('purchase', 'r')} USING (user_id, w)",
)
def join_window_inner(t):
    rows = joins.window_join(side(t, "view", "l"), side(t, "purchase", "r"), ["user_id"], "l_ts", "r_ts", DAY)
    return rows.select("user_id", "l_value", "r_value", epoch_ms(F.col("l_ts")).alias("l_ms"), epoch_ms(F.col("r_ts")).alias("r_ms"))


PAIR_TEXT_SQL = f"""SELECT printf('user %d: %d with %d', user_id, l_id, r_id) AS text
    FROM {side_sql('click', 'l', HALF_DAY)} JOIN {side_sql('error', 'r', HALF_DAY)} USING (user_id, w)"""


def _pair_text(t):
    rows = joins.window_join(side(t, "click", "l"), side(t, "error", "r"), ["user_id"], "l_ts", "r_ts", HALF_DAY)
    return rows.select(F.format_string("user %d: %d with %d", "user_id", "l_id", "r_id").alias("text"))


query("join_window_inner_proc", PAIR_TEXT_SQL)(_pair_text)


def _write_pair(left, right):
    """The user's join function: what to make of a left and a right row."""
    return [F.concat(F.lit("user "), left("user_id"), F.lit(": "), left("l_id"), F.lit(" with "), right("r_id")).alias("text")]


@query("fn_join", PAIR_TEXT_SQL)
def fn_join(t):
    return joins.join_function(side(t, "click", "l"), side(t, "error", "r"), ["user_id"], "l_ts", "r_ts", HALF_DAY, _write_pair)


@query(
    "join_window_left_last",
    f"""SELECT l.user_id, l_id, r_value, coalesce(r_ms, -1) AS r_ms FROM {side_sql('view', 'l')} l
        LEFT JOIN (SELECT * FROM {side_sql('purchase', 'r')} QUALIFY row_number() OVER (PARTITION BY user_id, w ORDER BY r_id DESC) = 1) r USING (user_id, w)""",
)
def join_window_left_last(t):
    rows = joins.window_join(
        side(t, "view", "l"), side(t, "purchase", "r"), ["user_id"], "l_ts", "r_ts", DAY, how="left", last_by=["r_id"]
    )
    return rows.select("user_id", "l_id", "r_value", F.coalesce(epoch_ms(F.col("r_ts")), F.lit(-1)).alias("r_ms"))


LEFT_ALL_SQL = f"SELECT l.user_id, l_id, r_id FROM {side_sql('view', 'l')} l LEFT JOIN {side_sql('purchase', 'r')} r USING (user_id, w)"


def _left_all(t):
    rows = joins.window_join(side(t, "view", "l"), side(t, "purchase", "r"), ["user_id"], "l_ts", "r_ts", DAY, how="left")
    return rows.select("user_id", "l_id", "r_id")


query("join_window_left_all", LEFT_ALL_SQL)(_left_all)


def _left_or_all(left, right):
    """The user's co-group function: every left row with every right row, or alone."""
    ids = F.when(F.size(right) > 0, F.transform(right, lambda r: r["r_id"])).otherwise(F.array(F.lit(None).cast("long")))
    return F.flatten(F.transform(left, lambda l: F.transform(ids, lambda r: F.struct(l["user_id"].alias("user_id"), l["l_id"].alias("l_id"), r.alias("r_id")))))


@query("fn_cogroup", LEFT_ALL_SQL)
def fn_cogroup(t):
    sides = [side(t, kind, name).select("user_id", f"{name}_id", f"{name}_ts") for kind, name in (("view", "l"), ("purchase", "r"))]
    return joins.cogroup_function(*sides, ["user_id"], "l_ts", "r_ts", DAY, _left_or_all, ("l_id", "r_id"))


@query(
    "join_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_totalprice AS order_total, o_orderpriority AS order_priority
       FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey""",
)
def join_lookup(t):
    table = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.lookup(lines, table, {"l_orderkey": "o_orderkey"}, prefix="order_")


def order_streams(t):
    """Detail and order change envelopes; the order comes first, its lines every two seconds after it."""
    change = lambda c, codes: F.element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), F.col(c))
    born = F.col("o_orderdate").cast("timestamp")
    # Both sides grow with the data, so they meet in a shuffle by order, as they would at full size.
    dates = t.orders.select("o_orderkey", "o_orderdate").hint("merge")
    lines = t.lineitem.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
    at = epoch_ms(born) + F.col("l_linenumber") * 2000
    detail = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").cast("int").alias("amount"),
        F.col("l_extendedprice").alias("money"),
        F.timestamp_millis(at).alias("create_time"),
    )
    details = lines.select(
        (at + F.when(F.col("l_partkey") % 10 == 0, F.lit(3 * DAY)).otherwise(F.lit(0))).alias("arrived"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        "l_partkey",
        "l_suppkey",
        F.to_json(F.struct(change("l_returnflag", {"A": "INSERT", "N": "UPDATE", "R": "DELETE"}).alias("type"), F.array(detail).alias("data"))).alias("envelope"),
    )
    main = F.struct(
        F.col("o_orderkey").alias("oid"),
        born.alias("create_time"),
        F.col("o_totalprice").alias("total_money"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("province"),
    )
    mains = t.orders.select(
        epoch_ms(born).alias("arrived"),
        "o_orderkey",
        F.to_json(F.struct(change("o_orderstatus", {"F": "INSERT", "O": "UPDATE", "P": "DELETE"}).alias("type"), F.array(main).alias("data"))).alias("envelope"),
    )
    table = t.orders.select(
        F.col("o_orderkey").alias("oid"), F.col("o_totalprice").alias("total_money"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("province")
    )
    return details, mains, table


@query(
    "order_enrich",
    f"""WITH d AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku, l_suppkey AS supplier,
                     epoch_us(o_orderdate) // 1000 + l_linenumber * 2000 AS ms, l_returnflag
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'N')),
             w AS (SELECT *, max(ms) OVER (ORDER BY ms + CASE WHEN sku % 10 = 0 THEN {3 * DAY} ELSE 0 END, id, sku, supplier
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2001 AS wm FROM d),
             x AS (SELECT *, coalesce(ms - ms % 5000 + 5000 - 1 <= wm, false) AS late FROM w),
             j AS (SELECT x.*, m.o_orderkey IS NOT NULL AS met FROM x LEFT JOIN orders m
                     ON NOT late AND m.o_orderkey = order_id AND m.o_orderstatus IN ('F', 'O') AND (epoch_us(m.o_orderdate) // 1000) // 5000 = ms // 5000)
        SELECT id, sku, supplier, CASE l_returnflag WHEN 'A' THEN 'INSERT' ELSE 'UPDATE' END AS change,
          CASE WHEN met THEN 'window' WHEN late THEN 'late' ELSE 'miss' END AS via, o_totalprice AS total_money, o_orderstatus AS status
        FROM j LEFT JOIN orders o ON o.o_orderkey = order_id""",
)
def order_enrich(t):
    details, mains, table = order_streams(t)
    rows = enrich_orders(details, mains, table, ["arrived", "line", "l_partkey", "l_suppkey"], ["arrived", "o_orderkey"])
    return rows.select("id", "sku", "supplier", "change", "via", "total_money", "status")


FIELDS_SQL = "(SELECT p_partkey, unnest(list_filter(string_split(p_name, ' '), lambda f: f <> '')) AS field FROM part)"


@query("join_lateral_tvf", f"SELECT p_partkey, field, CAST(length(field) AS INTEGER) AS length FROM {FIELDS_SQL}")
def join_lateral_tvf(t):
    return field_lengths(t.part, "p_name", ("p_partkey",))


@query(
    "join_lateral_tvf_left",
    f"""SELECT p.p_partkey, field, CAST(length(field) AS INTEGER) AS length FROM part p
        LEFT JOIN {FIELDS_SQL} f ON f.p_partkey = p.p_partkey AND p_size > 20""",
)
def join_lateral_tvf_left(t):
    named = t.part.select("p_partkey", F.when(F.col("p_size") > 20, F.col("p_name")).alias("name"))
    return field_lengths(named, "name", ("p_partkey",), outer=True)


def _two(t):
    keep = ["user_id", "event_id", "ts", "value"]
    return t.events.where("event_type = 'view'").select(*keep), t.events.where("event_type = 'purchase'").select(*keep)


PAIR_SQL = """(SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, CASE event_type WHEN 'view' THEN 'left' ELSE 'right' END AS src, value AS n,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type IN ('view', 'purchase'))"""


@query(
    "pair_sum_timeout",
    f"""WITH RECURSIVE e AS {PAIR_SQL},
        st AS (
          SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS side, CAST(NULL AS DOUBLE) AS held, CAST([] AS BIGINT[]) AS timers, CAST(NULL AS BIGINT) AS latest,
                 CAST(NULL AS BIGINT) AS f_at, CAST(NULL AS VARCHAR) AS f_kind, CAST(NULL AS DOUBLE) AS f_total, CAST(NULL AS BIGINT) AS s_at, CAST(NULL AS DOUBLE) AS s_total
          FROM (SELECT DISTINCT user_id FROM e)
          UNION ALL
          SELECT user_id, rn, CASE WHEN stores THEN src END, CASE WHEN stores THEN n END,
                 CASE WHEN stores THEN list_append(timers1, ms + {HALF_DAY}) ELSE list_filter(timers1, lambda x: x <> latest) END,
                 CASE WHEN stores THEN ms + {HALF_DAY} END,
                 CASE WHEN side IS NOT NULL THEN due END, CASE WHEN due IS NOT NULL THEN side END, CASE WHEN due IS NOT NULL THEN held END,
                 CASE WHEN NOT stores THEN ms END, CASE WHEN NOT stores THEN n + held1 END
          FROM (SELECT *, side1 IS NULL OR side1 = src AS stores FROM (
                  SELECT *, CASE WHEN due IS NULL THEN side END AS side1, CASE WHEN due IS NULL THEN held END AS held1 FROM (
                    SELECT st.user_id, e.rn, e.ms, e.src, e.n, st.side, st.held, st.latest,
                           list_min(list_filter(st.timers, lambda x: x <= e.ms)) AS due, list_filter(st.timers, lambda x: x > e.ms) AS timers1
                    FROM st JOIN e ON e.user_id = st.user_id AND e.rn = st.rn + 1))))
        SELECT user_id, f_at AS at_ms, f_kind AS kind, round(f_total, 4) AS total FROM st WHERE f_at IS NOT NULL
        UNION ALL SELECT user_id, s_at, 'sum', round(s_total, 4) FROM st WHERE s_at IS NOT NULL
        UNION ALL SELECT user_id, list_min(timers), side, round(held, 4) FROM st
          WHERE side IS NOT NULL AND rn = (SELECT max(rn) FROM e WHERE e.user_id = st.user_id)""",
)
def pair_sum_timeout(t):
    left, right = _two(t)
    rows = machines.pair_sum(left, right, ["user_id"], ["event_id"], "ts", "value", HALF_DAY)
    return rows.withColumn("total", F.round("total", 4))


@query(
    "pair_sum_accumulate",
    f"""WITH e AS {PAIR_SQL},
        a AS (SELECT *, CASE WHEN lag(src) OVER w IS NULL OR lag(src) OVER w = src THEN rn END AS sync FROM e WINDOW w AS (PARTITION BY user_id ORDER BY rn)),
        b AS (SELECT *, (rn - max(sync) OVER (PARTITION BY user_id ORDER BY rn)) % 2 = 1 AS hit FROM a),
        c AS (SELECT *, coalesce(sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg,
                lead(hit) OVER (PARTITION BY user_id ORDER BY rn) AS nhit, lead(ms) OVER (PARTITION BY user_id ORDER BY rn) AS nms FROM b),
        d AS (SELECT *, sum(n) OVER (PARTITION BY user_id, seg ORDER BY rn) AS total FROM c),
        timers AS (SELECT user_id, ms + {HALF_DAY} AS at_ms FROM d WHERE NOT hit AND NOT coalesce(nhit AND nms < ms + {HALF_DAY}, false)),
        fired AS (SELECT t.user_id, t.at_ms, d.src, d.total, d.hit FROM timers t ASOF JOIN d ON t.user_id = d.user_id AND t.at_ms > d.ms)
        SELECT user_id, ms AS at_ms, 'sum' AS kind, round(total, 4) AS total FROM d WHERE hit
        UNION ALL SELECT user_id, at_ms, src, round(total, 4) FROM fired WHERE NOT hit""",
)
def pair_sum_accumulate(t):
    left, right = _two(t)
    rows = pairs.pair_sum_accumulate(left, right, ["user_id"], ["event_id"], "ts", "value", HALF_DAY)
    return rows.withColumn("total", F.round("total", 4))


@query(
    "pair_sum_sticky",
    f"""WITH e AS {PAIR_SQL}, f AS (SELECT *, first_value(src) OVER (PARTITION BY user_id ORDER BY rn) AS head FROM e),
        g AS (SELECT *, last_value(CASE WHEN src = head THEN n END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored FROM f)
        SELECT user_id, event_id, ms AS at_ms, round(n + stored, 4) AS total FROM g WHERE src <> head""",
)
def pair_sum_sticky(t):
    left, right = _two(t)
    rows = pairs.pair_sum_sticky(left, right, ["user_id"], ["event_id"], "ts", "value")
    return rows.withColumn("total", F.round("total", 4))


@query(
    "bcast_blacklist",
    """WITH r AS (SELECT ts, CASE user_id % 3 WHEN 0 THEN ['view', 'click'] WHEN 1 THEN ['error'] ELSE ['purchase', 'view'] END AS words FROM events WHERE event_type = 'signup'),
            x AS (SELECT e.event_id, e.event_type, coalesce(r.words, ['click']) AS words FROM (SELECT * FROM events WHERE event_type <> 'signup') e ASOF LEFT JOIN r ON e.ts >= r.ts)
       SELECT event_id, array_to_string(words, ',') AS word_set, CASE WHEN list_contains(words, event_type) THEN 'blocked' ELSE 'passed' END AS tag FROM x""",
)
def bcast_blacklist(t):
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    chosen = F.when(F.col("user_id") % 3 == 0, words("view", "click")).when(F.col("user_id") % 3 == 1, words("error")).otherwise(words("purchase", "view"))
    control = t.events.where("event_type = 'signup'").select("ts", "event_id", chosen.alias("words"))
    records = t.events.where("event_type <> 'signup'").select("ts", "event_id", "event_type")
    rows = rules.block_listed(records, control, "ts", "event_id", "event_type", "words", ["click"])
    return rows.select("event_id", F.array_join("word_set", ",").alias("word_set"), "tag")


@query(
    "bcast_keyed_rules",
    """WITH r AS (SELECT ts, CASE WHEN user_id % 2 = 0 THEN 'view' ELSE 'click' END AS a, CASE WHEN user_id % 3 = 0 THEN 'purchase' ELSE 'error' END AS b, 't' || (user_id % 5) AS topic
                  FROM events WHERE event_type = 'signup'),
            e AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_action FROM events WHERE event_type <> 'signup')
       SELECT e.event_id, e.user_id, e.event_type, e.prev_action, r.topic FROM e ASOF JOIN r ON e.ts >= r.ts WHERE prev_action = a AND event_type = b""",
)
def bcast_keyed_rules(t):
    control = t.events.where("event_type = 'signup'").select(
        "ts",
        "event_id",
        F.when(F.col("user_id") % 2 == 0, F.lit("view")).otherwise(F.lit("click")).alias("first_action"),
        F.when(F.col("user_id") % 3 == 0, F.lit("purchase")).otherwise(F.lit("error")).alias("second_action"),
        F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("topic"),
    )
    records = t.events.where("event_type <> 'signup'").select("ts", "event_id", "user_id", "event_type")
    rows = rules.matching_rule(records, control, "ts", "event_id", ["user_id"], "event_type", "first_action", "second_action", ["topic"])
    return rows.drop("ts")
