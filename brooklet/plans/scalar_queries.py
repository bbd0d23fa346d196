"""Projection, parsing, scalar functions, wide-column operations, splitting and connecting."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from brooklet.functions import parsing, scalars
from brooklet.operators import routing, widecol
from brooklet.plans.registry import query
from brooklet.plans.source_queries import CUSTOMER_WIDE_SQL, JAVA_HASH_SQL, WIDE_TEXT_SQL, wide_customers, wide_text

WORDS_SQL = """unnest(CASE WHEN {0} = '' THEN [''] WHEN rtrim({0}, ' ') = '' THEN [] ELSE string_split(rtrim({0}, ' '), ' ') END)"""


def _event_lines(t):
    """``id,type,value`` lines; every seventh lacks a field, every eleventh has a bad number."""
    bad = F.when(F.col("event_id") % 7 == 0, F.concat_ws(",", "event_id", "event_type")).when(
        F.col("event_id") % 11 == 0, F.concat_ws(",", "event_id", "event_type", F.lit("n/a"))
    )
    return t.events.select("event_id", F.coalesce(bad, F.concat_ws(",", "event_id", "event_type", "value")).alias("line"))


@query("map_split_fields", "SELECT event_id AS id, event_type AS kind, value AS reading FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def map_split_fields(t):
    rows = parsing.split_fields(_event_lines(t), "line", ",", "id long, kind string, reading double")
    return routing.select_output(rows, "ok").drop("line")


@query(
    "map_guard_malformed",
    """SELECT CASE WHEN ok THEN event_id END AS id, CASE WHEN ok THEN event_type END AS kind, CASE WHEN ok THEN value END AS reading,
              CASE WHEN ok THEN 'ok' ELSE 'bad' END AS tag, event_id
       FROM (SELECT *, event_id % 7 <> 0 AND event_id % 11 <> 0 AS ok FROM events)""",
)
def map_guard_malformed(t):
    return parsing.split_fields(_event_lines(t), "line", ",", "id long, kind string, reading double", keep=("event_id",)).drop("line")


@query("flatmap_words", f"SELECT conv_id, turn, {WORDS_SQL.format('text')} AS word FROM conversations")
def flatmap_words(t):
    return parsing.words(t.conversations, "text", keep=("conv_id", "turn"))


@query(
    "flatmap_skip_blank",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
             w AS (SELECT doc_id, {WORDS_SQL.format('line')} AS word FROM l WHERE length(trim(line, ' ')) > 0)
        SELECT doc_id, count(*) AS words, CAST(sum(length(word)) AS BIGINT) AS chars FROM w GROUP BY 1""",
)
def flatmap_skip_blank(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    rows = parsing.words(lines, "line", keep=("doc_id",), skip_blank=True)
    return rows.groupBy("doc_id").agg(F.count("*").alias("words"), F.sum(F.length("word")).alias("chars"))


@query("filter_even", "SELECT event_id, user_id FROM events WHERE user_id % 2 = 0")
def filter_even(t):
    return t.events.where(F.col("user_id") % 2 == 0).select("event_id", "user_id")


@query("filter_threshold", "SELECT event_id, value FROM events WHERE value >= 30")
def filter_threshold(t):
    return t.events.where(F.col("value") >= 30).select("event_id", "value")


@query("table_select_filter", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'")
def table_select_filter(t):
    return t.customer.select("c_custkey", "c_mktsegment").filter("c_mktsegment = 'MACHINERY'")


@query("table_rename", "SELECT user_id AS userId, event_type FROM events")
def table_rename(t):
    return t.events.withColumnRenamed("user_id", "userId").select("userId", "event_type")


@query("table_select_range", "SELECT c_name, c_nationkey FROM customer")
def table_select_range(t):
    first, last = 2, 3
    return t.customer.select(t.customer.columns[first - 1 : last])


@query("table_sql", "SELECT * FROM supplier")
def table_sql(t):
    t.supplier.createOrReplaceTempView("supplier_view")
    return t.spark.sql("SELECT * FROM supplier_view")


@query(
    "fn_concat_format",
    "SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'even: ' ELSE 'odd: ' END || user_id AS label, printf('key:%s, id:%d', event_type, event_id) AS line FROM events",
)
def fn_concat_format(t):
    label = F.when(F.col("user_id") % 2 == 0, parsing.labelled(F.col("user_id"), "even: ")).otherwise(parsing.labelled(F.col("user_id"), "odd: "))
    return t.events.select("event_id", label.alias("label"), F.format_string("key:%s, id:%d", "event_type", "event_id").alias("line"))


@query(
    "fn_parse_ts",
    "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN epoch_ms(date_trunc('second', ts)) END AS ms FROM events",
)
def fn_parse_ts(t):
    text = F.when(F.col("event_id") % 9 == 0, F.lit("no time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", scalars.epoch_ms(scalars.parse_ts(text)).alias("ms"))


@query(
    "fn_format_ts",
    """SELECT event_id, strftime(ts, '%Y%m%d %H:%M:%S') AS compact, strftime(ts, '%I:%M:%S') AS half_day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS full_text FROM events""",
)
def fn_format_ts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        scalars.format_ts(ts, "yyyyMMdd HH:mm:ss").alias("compact"),
        scalars.format_ts(ts, "hh:mm:ss").alias("half_day"),
        scalars.format_ts(ts).alias("full_text"),
    )


@query("fn_md5", "SELECT doc_id, md5(text) AS digest FROM documents")
def fn_md5(t):
    return t.documents.select("doc_id", scalars.md5_hex(F.col("text")).alias("digest"))


@query(
    "fn_java_hash",
    f"""WITH h AS (SELECT doc_id, {JAVA_HASH_SQL.format('text')} AS u FROM documents)
        SELECT doc_id, CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INTEGER) AS h FROM h""",
)
def fn_java_hash(t):
    return t.documents.select("doc_id", scalars.java_hash(F.col("text")).alias("h"))


@query("fn_json_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, json_extract_string(doc, '$.page.page_id') AS page_id FROM (SELECT *, json_object('page', json_object('page_id', event_type)) AS doc FROM events)")
def fn_json_path(t):
    doc = F.to_json(F.struct(F.struct(F.col("event_type").alias("page_id")).alias("page")))
    return t.events.select(
        "event_id", scalars.json_path(F.col("props"), "k").alias("k"), scalars.json_path(doc, "page.page_id").alias("page_id")
    )


def _envelopes(t, per: int = 50):
    """Change envelopes of orders: ``per`` rows each, the type by order status, some of them broken."""
    kind = F.element_at(F.create_map(F.lit("F"), F.lit("INSERT"), F.lit("O"), F.lit("UPDATE"), F.lit("P"), F.lit("DELETE")), F.col("o_orderstatus"))
    row = F.struct(F.col("o_orderkey").alias("oid"), F.col("o_totalprice").alias("total_money"), F.col("o_orderpriority").alias("province"))
    grouped = t.orders.groupBy(kind.alias("type"), F.floor(F.col("o_orderkey") / per).alias("block")).agg(F.collect_list(row).alias("data"))
    text = F.to_json(F.struct("type", "data"))
    return grouped.select("block", F.when(F.col("block") % 13 == 0, F.substring(text, 1, 20)).otherwise(text).alias("envelope"))


@query(
    "json_explode_cdc",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'INSERT' ELSE 'UPDATE' END AS type, o_orderkey AS oid, o_totalprice AS total_money, o_orderpriority AS province
       FROM orders WHERE o_orderstatus IN ('F', 'O') AND (o_orderkey // 50) % 13 <> 0""",
)
def json_explode_cdc(t):
    return parsing.cdc_rows(_envelopes(t), "envelope", "oid long, total_money double, province string")


@query(
    "json_data_array",
    "SELECT CAST(o_orderkey AS VARCHAR) AS oid, o_orderpriority AS province FROM orders WHERE (o_orderkey // 50) % 13 <> 0",
)
def json_data_array(t):
    rows = parsing.data_maps(_envelopes(t), "envelope")
    return rows.select(F.col("entry")["oid"].alias("oid"), F.col("entry")["province"].alias("province"))


def _wide(where: str, cells: str = WIDE_TEXT_SQL) -> str:
    return f"SELECT rowkey, {cells} AS cells FROM {CUSTOMER_WIDE_SQL} WHERE {where}"


@query("wc_rowkey_regex", _wide("regexp_matches(rowkey, '^f[ef].+$')"))
def wc_rowkey_regex(t):
    return wide_text(widecol.scan(wide_customers(t), rowkey_regex="^f[ef].+$"))


@query("wc_cell_equals", _wide("segment = 'BUILDING' AND balance IS NULL", "'money:segment=' || segment"))
def wc_cell_equals(t):
    return wide_text(widecol.scan(wide_customers(t), equal=["money:segment:BUILDING", "money:balance:null"]))


@query("wc_cell_interval", _wide("(balance IS NULL OR (balance >= '1500' AND balance <= '3')) AND nation <> '4' AND segment > 'B' AND segment < 'M'"))
def wc_cell_interval(t):
    terms = [
        "greated_or_equal:money:balance:1500",
        "less_or_equal:money:balance:3",
        "not_equal:info:nation:4",
        "greated:money:segment:B",
        "less:money:segment:M",
        "nearly:info:nation:4",
    ]
    return wide_text(widecol.scan(wide_customers(t), intervals=terms))


@query(
    "wc_cell_regex",
    _wide(
        "regexp_matches(name, '7$') AND (balance IS NULL OR regexp_matches(balance, '^1'))",
        "concat_ws(';', 'info:name=' || name, 'info:nation=' || nation, 'money:balance=' || balance)",
    ),
)
def wc_cell_regex(t):
    return wide_text(widecol.scan(wide_customers(t), regexes=["info:name:7$", "money:balance:^1"], columns=["info:nation"]))


@query("wc_cell_contains", _wide("contains(lower(segment), 'mach') AND (balance IS NULL OR contains(balance, '99'))"))
def wc_cell_contains(t):
    return wide_text(widecol.scan(wide_customers(t), containing=["money:segment:mAcH", "money:balance:99"]))


@query("wc_project", _wide("true", "'info:name=' || name || ';info:nation=' || nation"))
def wc_project(t):
    return wide_text(widecol.scan(wide_customers(t), columns=["info:name", "info:nation"]))


@query("wc_get", _wide("rowkey = md5('Customer#000000042')"))
def wc_get(t):
    return wide_text(widecol.get(wide_customers(t), hashlib.md5(b"Customer#000000042").hexdigest()))


@query(
    "wc_multi_get",
    f"""WITH k AS (SELECT s_suppkey AS position, md5('Customer#' || lpad(CAST(s_suppkey * 20 AS VARCHAR), 9, '0')) AS rowkey FROM supplier)
        SELECT position, k.rowkey, CASE WHEN name IS NOT NULL THEN 'info:name=' || name || ';money:segment=' || segment END AS cells
        FROM k LEFT JOIN {CUSTOMER_WIDE_SQL} c ON c.rowkey = k.rowkey""",
)
def wc_multi_get(t):
    name = F.concat(F.lit("Customer#"), F.lpad((F.col("s_suppkey") * 20).cast("string"), 9, "0"))
    keys = t.supplier.select(F.col("s_suppkey").alias("position"), F.md5(name).alias("rowkey"))
    return wide_text(widecol.multi_get(wide_customers(t), keys, ["info:name", "money:segment"]))


@query("wc_range_scan", _wide("rowkey >= '40' AND rowkey < '8a'"))
def wc_range_scan(t):
    return wide_text(widecol.scan(wide_customers(t), start="40", stop="8a"))


@query(
    "wc_put",
    f"""SELECT rowkey, concat_ws(';', 'info:name=' || name, 'info:nation=' || nation, 'money:balance=' || CASE WHEN nation = '3' THEN '0' ELSE balance END,
            'money:segment=' || segment, CASE WHEN nation = '3' THEN 'note:text=reset' END) AS cells FROM {CUSTOMER_WIDE_SQL}
        UNION ALL SELECT md5(s_name), 'note:text=supplier' FROM supplier""",
)
def wc_put(t):
    rows = wide_customers(t)
    reset = widecol.to_rows(t.customer.where("c_nationkey = 3"), F.md5("c_name"), {"money:balance": F.lit("0"), "note:text": F.lit("reset")})
    added = widecol.to_rows(t.supplier, F.md5("s_name"), {"note:text": F.lit("supplier")})
    return wide_text(widecol.put(rows, reset.unionByName(added)))


@query(
    "wc_delete",
    f"""SELECT rowkey, CASE WHEN nation = '5' THEN 'info:name=' || name || ';info:nation=' || nation ELSE {WIDE_TEXT_SQL} END AS cells
        FROM {CUSTOMER_WIDE_SQL} WHERE nation <> '3'""",
)
def wc_delete(t):
    of_nation = lambda n: t.customer.where(F.col("c_nationkey") == n).select(F.md5("c_name").alias("rowkey"))
    left = widecol.delete(wide_customers(t), of_nation(3))
    return wide_text(widecol.delete(left, of_nation(5), ["money:balance", "money:segment"]))


@query(
    "union_all",
    "SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE value >= 60 UNION ALL SELECT o_orderkey FROM orders",
)
def union_all(t):
    ids = t.events.select("event_id")
    return routing.union(ids, t.events.where("value >= 60").select("event_id"), t.orders.select(F.col("o_orderkey").alias("event_id")))


@query("connect_comap", "SELECT event_id || 'change' AS value FROM events UNION ALL SELECT text FROM conversations")
def connect_comap(t):
    return routing.connect(
        t.events,
        t.conversations,
        lambda e: e.select(F.concat(F.col("event_id").cast("string"), F.lit("change")).alias("value")),
        lambda c: c.select(F.col("text").alias("value")),
    )


@query(
    "connect_coflatmap",
    f"""SELECT 'talk:' || {WORDS_SQL.format('text')} AS word FROM conversations
        UNION ALL SELECT {WORDS_SQL.format('p_name')} FROM part""",
)
def connect_coflatmap(t):
    return routing.connect(
        t.conversations,
        t.part,
        lambda c: parsing.words(c, "text").select(F.concat(F.lit("talk:"), "word").alias("word")),
        lambda p: parsing.words(p, "p_name"),
    )


@query(
    "connect_coprocess_tag",
    """SELECT 'socket one:' || event_type AS key, value AS n FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT 'socket two:' || event_type, value FROM events WHERE event_id % 2 = 1""",
)
def connect_coprocess_tag(t):
    def prefixed(text):
        return lambda df: df.select(F.concat(F.lit(text), "event_type").alias("key"), F.col("value").alias("n"))

    return routing.connect(t.events.where("event_id % 2 = 0"), t.events.where("event_id % 2 = 1"), prefixed("socket one:"), prefixed("socket two:"))


@query(
    "split_select",
    """SELECT event_id, tag FROM (SELECT event_id, 'even' AS tag FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT event_id, 'odd' FROM events WHERE event_id % 2 = 1 UNION ALL SELECT event_id, 'high' FROM events WHERE value > 28)""",
)
def split_select(t):
    even = F.col("event_id") % 2 == 0
    rows = routing.split_multi(t.events, {"even": even, "odd": ~even, "high": F.col("value") > 28})
    return rows.select("event_id", F.explode("tags").alias("tag"))


@query(
    "side_output_parity",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM events UNION ALL SELECT event_id, 'main' FROM events""",
)
def side_output_parity(t):
    even = F.col("event_id") % 2 == 0
    return routing.with_side_outputs(t.events, {"even": even, "odd": ~even}).select("event_id", "tag")
