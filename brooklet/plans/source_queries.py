"""Sources and sinks. File queries write lines derived from the tables into a new folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from brooklet.functions.scalars import epoch_ms
from brooklet.operators import widecol
from brooklet.plans.registry import query
from brooklet.sinks import documents, files, log
from brooklet.sinks.jdbc import latest_per_key
from brooklet.sources import files as src
from brooklet.sources.generators import shape
from brooklet.sources.jdbc import as_field_maps
from brooklet.sources.log import decode_log
from brooklet.streaming.exactly_once import batch_files, read_batches, write_stream

LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS value FROM conversations"
CUSTOMER_WIDE_SQL = """(SELECT md5(c_name) AS rowkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
    CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) END AS balance, c_mktsegment AS segment FROM customer)"""
WIDE_TEXT_SQL = """concat_ws(';', 'info:name=' || name, 'info:nation=' || nation, 'money:balance=' || balance,
    'money:segment=' || segment)"""


def wide_customers(t):
    cells = {
        "info:name": F.col("c_name"),
        "info:nation": F.col("c_nationkey"),
        "money:balance": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "money:segment": F.col("c_mktsegment"),
    }
    return widecol.to_rows(t.customer, F.md5("c_name"), cells)


def wide_text(df):
    """Cells as ``name=value;...`` in name order, to compare maps."""
    pairs = F.transform(F.array_sort(F.map_entries("cols")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return df.withColumn("cells", F.array_join(pairs, ";")).drop("cols")


def _line_folder(t, name):
    path = t.fresh_path(name)
    t.conversations.select("text").write.text(path)
    return path


@query("src_text", LINES_SQL)
def src_text(t):
    return src.read_lines(t.spark, _line_folder(t, "text"))


def _stream_lines(t, name):
    watched, out = _line_folder(t, name), t.fresh_path(name)
    lines = src.watch_dir(t.spark, watched)
    write_stream(lines, batch_files(out + "/rows"), out + "/checkpoint").awaitTermination()
    return read_batches(t.spark, out + "/rows").select("value")


@query("src_dir_monitor", LINES_SQL)
def src_dir_monitor(t):
    return _stream_lines(t, "monitor")


@query("src_socket_lines", f"SELECT length(value) AS chars, count(*) AS n FROM ({LINES_SQL}) GROUP BY 1")
def src_socket_lines(t):
    return _stream_lines(t, "lines").groupBy(F.length("value").cast("long").alias("chars")).agg(F.count("*").alias("n"))


@query(
    "src_elements",
    """SELECT e.label, count(*) AS n FROM events
       JOIN (VALUES ('view', 'look'), ('click', 'look'), ('purchase', 'pay'), ('error', 'fail')) e(event_type, label)
       USING (event_type) GROUP BY 1""",
)
def src_elements(t):
    rows = [("view", "look"), ("click", "look"), ("purchase", "pay"), ("error", "fail")]
    labels = src.elements(t.spark, rows, "event_type string, label string")
    return t.events.join(F.broadcast(labels), "event_type").groupBy("label").agg(F.count("*").alias("n"))


@query(
    "src_sequence",
    """SELECT n FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) r(n)
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = n)""",
)
def src_sequence(t):
    return src.key_range(t.orders, "o_orderkey").join(t.lineitem, F.col("n") == F.col("l_orderkey"), "left_anti")


@query(
    "src_generator",
    """SELECT event_id AS id, ['north', 'east', 'south', 'west'][event_id % 4 + 1] AS value, event_id * 2000 AS ms FROM events""",
)
def src_generator(t):
    rows = shape(t.events.select(F.col("event_id").alias("id")), "cycle", gap_ms=2000, choices=["north", "east", "south", "west"])
    return rows.select("id", "value", epoch_ms(F.col("ts")).alias("ms"))


@query("src_paced_file_replay", "SELECT event_type AS k, value AS v, epoch_us(ts) // 1000 AS ms FROM events")
def src_paced_file_replay(t):
    path = t.fresh_path("replay")
    t.events.select("event_type", "value", epoch_ms(F.col("ts"))).write.csv(path)
    return t.spark.read.schema("k string, v double, ms long").csv(path)


@query(
    "src_csv_table",
    "SELECT segment, count(*) AS n, round(sum(balance), 2) AS total FROM (SELECT c_mktsegment AS segment, c_acctbal AS balance FROM customer) GROUP BY 1",
)
def src_csv_table(t):
    path = t.fresh_path("csv")
    t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").write.csv(path)
    src.read_csv_table(t.spark, path, "id long, segment string, balance double", view="customer_csv")
    return t.spark.sql("SELECT segment, count(*) AS n, round(sum(balance), 2) AS total FROM customer_csv GROUP BY segment")


@query(
    "src_wide_column_scan",
    f"""SELECT rowkey, concat_ws(';', 'info:nation=' || nation, 'money:balance=' || balance) AS cells FROM {CUSTOMER_WIDE_SQL}
        WHERE regexp_matches(rowkey, '^[0-7]') AND nation = '7' AND (balance IS NULL OR balance >= '2')""",
)
def src_wide_column_scan(t):
    found = widecol.scan(
        wide_customers(t),
        rowkey_regex="^[0-7]",
        equal=["info:nation:7"],
        intervals=["greated_or_equal:money:balance:2"],
        columns=["money:balance"],
    )
    return wide_text(found)


def _records(t):
    return t.events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )


@query(
    "src_log_records",
    """WITH r AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
                  CAST(user_id AS VARCHAR) AS key, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
                  WHERE event_type IN ('view', 'click')),
            s AS (SELECT topic, "partition", (min("offset") + max("offset")) // 2 AS start FROM r WHERE "partition" < 2 GROUP BY ALL)
       SELECT r.* FROM r LEFT JOIN s USING (topic, "partition") WHERE "offset" >= coalesce(start, 0)""",
)
def src_log_records(t):
    records = _records(t)
    middle = F.floor((F.min("offset") + F.max("offset")) / 2).alias("start")
    starts = records.where(F.col("partition") < 2).groupBy("topic", "partition").agg(middle)
    return decode_log(records, "k int", topics=["view", "click"], start_offsets=starts)


@query(
    "src_jdbc_dynamic",
    "SELECT concat_ws(';', 's_acctbal=' || s_acctbal, 's_name=' || s_name, 's_nationkey=' || s_nationkey, 's_suppkey=' || s_suppkey) AS cells FROM supplier",
)
def src_jdbc_dynamic(t):
    """The row shape of the reader that learns its columns at run time, on a table at hand."""
    return wide_text(as_field_maps(t.supplier, "cols"))


@query("sink_row_file", "SELECT 'Reading(' || event_id || ',' || event_type || ',' || value || ')' AS value FROM events WHERE value >= 60")
def sink_row_file(t):
    path = t.fresh_path("rows")
    rows = t.events.where(F.col("value") >= 60).select("event_id", "event_type", "value")
    files.write_rows(rows, path, name="Reading")
    return src.read_lines(t.spark, path)


@query("sink_csv_table", "SELECT c_custkey AS id, c_name AS name FROM customer")
def sink_csv_table(t):
    path = t.fresh_path("table")
    files.write_csv_table(t.customer, path, ["c_custkey", "c_name"])
    return src.read_csv_table(t.spark, path, "id long, name string")


@query(
    "sink_log_append",
    """SELECT 'busy' AS topic, CAST(user_id AS VARCHAR) AS key, 'user:' || user_id || ',' || event_type AS value FROM events WHERE event_type <> 'error'
       UNION ALL SELECT 'failed', CAST(user_id AS VARCHAR), 'user:' || user_id || ',' || event_type FROM events WHERE event_type = 'error'""",
)
def sink_log_append(t):
    path = t.fresh_path("log")
    topic = F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("busy"))
    rows = t.events.select(F.concat(F.lit("user:"), "user_id").alias("who"), "event_type", "user_id")
    records = log.to_log(rows, topic, key=F.col("user_id"), columns=["who", "event_type"])
    log.append_log(records, path)
    return t.spark.read.schema("key string, value string, topic string").parquet(path)


JAVA_HASH_SQL = """CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({0}, ''), lambda c: CAST(unicode(c) AS BIGINT))),
    lambda a, c: (a * 31 + c) % 4294967296) AS BIGINT)"""


@query(
    "sink_key_partition",
    f"""WITH h AS (SELECT c_name AS key, {JAVA_HASH_SQL.format('c_name')} AS u FROM customer)
        SELECT key, CAST(((CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END) % 7 + 7) % 7 AS INTEGER) AS "partition" FROM h""",
)
def sink_key_partition(t):
    return log.with_partition(t.customer.select(F.col("c_name").alias("key")), 7)


@query(
    "sink_jdbc_upsert",
    """SELECT o_custkey, o_orderstatus, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def sink_jdbc_upsert(t):
    """The rows the upsert sink sends to the database: the latest per key."""
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    return latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "sink_exactly_once",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def sink_exactly_once(t):
    """The same stream written twice with a lost checkpoint in between: replayed batches overwrite themselves."""
    out = t.fresh_path("once")
    stream = t.stream("events")
    for attempt in (1, 2):
        write_stream(stream, batch_files(out + "/rows"), f"{out}/checkpoint{attempt}").awaitTermination()
    rows = read_batches(t.spark, out + "/rows")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "sink_document_upsert",
    """SELECT md5(event_type || '/' || user_id) AS id, '{"event_type":"' || event_type || '","user_id":' || user_id || ',"last":' || max(event_id) || '}' AS body
       FROM events GROUP BY event_type, user_id""",
)
def sink_document_upsert(t):
    rows = t.events.select("event_type", "user_id", F.col("event_id").alias("last"))
    name = F.concat_ws("/", "event_type", F.col("user_id").cast("string"))
    old = documents.to_documents(rows.where(F.col("event_type") != "view"), name, ["event_type", "user_id"], ["last"])
    new = documents.to_documents(rows, name, ["event_type", "user_id", "last"], ["last"])
    return documents.upsert_documents(old, new)


@query(
    "sink_wide_column_put",
    """WITH c AS (SELECT md5(event_type || user_id) AS rowkey, max(event_id) AS last, max(event_id) FILTER (value >= 60) AS high,
                  max_by(CAST(value AS VARCHAR), event_id) FILTER (value >= 60) AS hv FROM events GROUP BY event_type, user_id)
       SELECT rowkey, concat_ws(';', 'f:last=' || last, 'g:high=' || hv) AS cells FROM c""",
)
def sink_wide_column_put(t):
    key = F.md5(F.concat("event_type", "user_id"))
    cells = {"f:last": F.col("event_id"), "g:high": F.when(F.col("value") >= 60, F.col("value"))}
    rows = widecol.to_rows(t.events.select("*"), key, cells)
    ordered = rows.withColumn("at", F.element_at("cols", "f:last").cast("long"))
    old = widecol.put(rows.limit(0), ordered.where(F.col("at") % 2 == 0), ["at"])
    return wide_text(widecol.put(old, ordered, ["at"]))
