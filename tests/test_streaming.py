"""Streaming forms against the batch forms on the same rows, delivered as several files in time order."""

import time

import pytest
from pyspark.sql import functions as F

from brooklet.operators import aggregates, eventtime, joins, machines, rules, stateful, windows
from brooklet.operators.patterns import Pattern, match
from brooklet.session import shared_folder
from brooklet.sinks.files import stream_rows
from brooklet.sources.files import read_lines, watch_csv, watch_dir
from brooklet.sources.generators import generate_stream
from brooklet.streaming import processors
from brooklet.streaming.patterns import match_stream
from brooklet.streaming.joins import followed_by_stream, window_join_stream
from brooklet.streaming.exactly_once import batch_files, latest_state, read_batches, tagged_files, write_stream
from tests.conftest import rows

HOUR = 3_600_000


@pytest.fixture
def feed(spark, events, tmp_path):
    """Events in four files by time, then one row a year later that pushes the watermark past everything."""
    folder = str(tmp_path / "in")
    data = events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")).cache()
    top = data.agg(F.max("event_id")).first()[0]
    for part in range(4):
        low, high = part * (top + 1) // 4, (part + 1) * (top + 1) // 4
        data.where((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(folder)
    flush = data.where(F.col("event_id") == top).select(
        (F.col("event_id") + 1).alias("event_id"), F.lit(-1).cast("long").alias("user_id"), F.lit("flush").alias("event_type"), "value", (F.col("ts") + F.expr("INTERVAL 365 DAYS")).alias("ts")
    )
    for _ in range(2):
        flush.coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return data, stream


def run(spark, df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    write_stream(df, batch_files(out + "/rows"), out + "/checkpoint", mode=mode).awaitTermination()
    return read_batches(spark, out + "/rows")


def test_window_sums(spark, feed, tmp_path):
    data, stream = feed
    agg = F.round(F.sum("value"), 4).alias("total")
    timed = eventtime.with_stream_watermark(stream(), "ts", 1000)
    got = run(spark, windows.tumble(timed, "ts", "1 hour", ["event_type"], agg), tmp_path).drop("batch_id")
    assert rows(got.where("event_type <> 'flush'")) == rows(windows.tumble(data, "ts", "1 hour", ["event_type"], agg))


def test_running_sum_ends_at_the_total(spark, feed, tmp_path):
    data, stream = feed
    totals = stream().groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    got = latest_state(run(spark, totals, tmp_path, mode="update"), ["user_id"], ["n", "total"])
    want = data.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    assert rows(got.where("user_id >= 0")) == rows(want)


def test_running_distinct(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, processors.running_distinct_stream(stream(), ["event_type"], "user_id", ["event_id"]), tmp_path)
    want = aggregates.running_distinct(data, ["event_type"], "user_id", ["event_id"])
    columns = ["event_id", "event_type", "users", "clicks"]
    assert rows(got.where("user_id >= 0"), *columns) == rows(want, *columns)


def test_over_rows(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, processors.over_rows_stream(stream(), ["user_id"], ["event_id"], 2, "value"), tmp_path)
    want = windows.over_rows(data, ["user_id"], ["event_id"], 2, "value")
    pick = ["event_id", "n", F.round("mean", 6).alias("mean")]
    assert rows(got.where("user_id >= 0"), *pick) == rows(want, *pick)


def test_changed_value(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, processors.changed_value_stream(stream(), ["user_id"], ["event_id"], "event_type"), tmp_path)
    want = stateful.changed_value(data, ["user_id"], ["event_id"], "event_type")
    columns = ["event_id", "event_type", "previous"]
    assert rows(got.where("user_id >= 0"), *columns) == rows(want, *columns)


def test_changed_value_with_nulls(spark, tmp_path):
    data = spark.createDataFrame([(1, 0, 5), (1, 1, None), (1, 2, 7), (1, 3, 8), (2, 4, None), (2, 5, 1)], "k int, o int, v int")
    data.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    got = run(spark, processors.changed_value_stream(stream, ["k"], ["o"], "v"), tmp_path)
    assert rows(got, "k", "o", "v", "previous") == rows(stateful.changed_value(data, ["k"], ["o"], "v"), "k", "o", "v", "previous") == [(1, 3, 8, 7)]


def test_rising_alert(spark, feed, tmp_path):
    data, stream = feed
    machine = machines.RisingAlert(6 * HOUR)
    got = run(spark, processors.run_machine(stream(), ["user_id"], ["row_ms", "event_id"], "ts", machine), tmp_path)
    want = machines.rising_alert(data, ["user_id"], ["event_id"], "ts", "value", 6 * HOUR)
    columns = ["user_id", "at_ms", "value"]
    assert rows(got.where("user_id >= 0"), *columns) == rows(want, *columns) != []


@pytest.mark.parametrize(
    "pattern",
    [
        Pattern.begin("a", lambda r: r("event_type") == "view").followed_by("b", lambda r: r("event_type") == "purchase").within(24 * HOUR),
        Pattern.begin("a", lambda r: r("value") > 30).next("b", lambda r: r("value") > 20).followed_by("c", lambda r: r("value") < 5).within(48 * HOUR),
        Pattern.begin("a", lambda r: r("event_type") == "error").within(HOUR),
    ],
)
def test_patterns_with_time_outs(spark, feed, tmp_path, pattern):
    data, stream = feed
    columns = ["event_id", "value", "ts"]
    got = run(spark, match_stream(stream(), ["user_id"], ["event_id"], "ts", pattern, columns), tmp_path).where("user_id >= 0")
    want = match(data, ["user_id"], ["ts", "event_id"], "ts", pattern, columns)
    shown = ["user_id", "outcome", *[f"{s.name}.{c}" for s in pattern.steps for c in ("event_id", "value")]]
    assert rows(got, *shown) == rows(want, *shown) != []


def test_patterns_at_equal_times_and_with_nulls(spark, tmp_path):
    data = [(1, 0, "go", 0), (1, 1, "end", 0), (1, 2, None, 5), (1, 3, "go", 6), (1, 4, "go", 7), (1, 5, None, 8), (1, 6, "end", 16), (2, 7, "go", 1), (9, 8, "x", 10**6)]
    df = spark.createDataFrame(data, "k int, o int, w string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + 1000))
    for part in range(2):
        df.coalesce(1).where(F.lit(part == 0) | (F.col("k") == 9)).write.mode("append").parquet(str(tmp_path / "in"))
    pattern = Pattern.begin("a", lambda r: r("w") == "go").followed_by("b", lambda r: r("w") == "end").within(10_000)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(spark, match_stream(stream, ["k"], ["o"], "ts", pattern, ["o"]), tmp_path).where("k < 9")
    want = match(df, ["k"], ["ts", "o"], "ts", pattern, ["o"])
    shown = ["k", "outcome", "a.o", "b.o"]
    assert rows(got, *shown) == rows(want, *shown)
    assert len(rows(got.where("outcome = 'timeout'"), *shown)) == 2


def test_cumulative_windows(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, processors.cumulative_stream(stream(), "ts", "6 hours", ["user_id"]), tmp_path)
    want = windows.cumulative(data, "ts", 6 * HOUR, ["user_id"])
    start = F.unix_millis("window_start").alias("w_start")
    assert rows(got.where("user_id >= 0"), "user_id", start, "n", "total") == rows(want, "user_id", "w_start", "n", "total")


def test_state_machine(spark, feed, tmp_path):
    data, stream = feed
    value = F.when(F.col("event_type") == "error", True).when(F.col("event_type") == "signup", False)
    marked = lambda df: df.withColumn("failed", value).where(F.col("failed").isNotNull() | (F.col("event_type") == "flush"))
    machine = machines.FailBurst(24 * HOUR, 2)
    rows_in = marked(stream()).withColumn("failed", F.coalesce("failed", F.lit(False)))
    got = run(spark, processors.run_machine(rows_in, ["user_id"], ["row_ms", "event_id"], "ts", machine), tmp_path)
    is_type = lambda name: F.col("event_type") == name
    want = machines.fail_burst(data, ["user_id"], ["event_id"], "ts", is_type("error"), is_type("signup"), 24 * HOUR)
    columns = ["user_id", "at_ms", "fails"]
    assert rows(got, *columns) == rows(want, *columns) != []


def test_late_rows_are_tagged_not_dropped(spark, events, tmp_path):
    folder = str(tmp_path / "in")
    data = events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts")).cache()
    middle = data.agg(F.max("event_id")).first()[0] // 2
    data.where(F.col("event_id") >= middle).coalesce(1).write.mode("append").parquet(folder)
    data.where(F.col("event_id") == middle).coalesce(1).write.mode("append").parquet(folder)
    data.where(F.col("event_id") < middle).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    tagged = processors.tag_late(stream, "ts", 1000, ["user_id"])
    out = str(tmp_path / "out")
    # Processing-time mode never runs out of batches: wait for the rows, then stop.
    query = write_stream(tagged, tagged_files(out + "/rows", ["late", "normal"]), out + "/checkpoint", processingTime="500 milliseconds")
    deadline, seen = time.time() + 60, 0
    while seen <= data.count() and time.time() < deadline:
        time.sleep(1)
        seen = sum(p["numInputRows"] for p in query.recentProgress)
    query.stop()
    got = read_batches(spark, out + "/rows")
    assert got.count() == data.count() + 1
    assert rows(got.where("tag = 'late'"), "event_id") == rows(data.where(F.col("event_id") <= middle), "event_id")


def test_lines_csv_and_row_files(spark, tmp_path):
    spark.range(20).select(F.concat_ws(",", F.col("id").cast("string"), (F.col("id") * 2).cast("string"))).repartition(4).write.text(str(tmp_path / "lines"))
    stream_rows(watch_dir(spark, str(tmp_path / "lines")), str(tmp_path / "rows"), str(tmp_path / "cp1"), name="Line").awaitTermination()
    assert len(rows(read_lines(spark, str(tmp_path / "rows")))) == 20
    paced = watch_csv(spark, str(tmp_path / "lines"), "a long, b long")
    got = run(spark, paced, tmp_path)
    assert got.agg(F.sum("b")).first()[0] == 380
    assert got.select("batch_id").distinct().count() == 4


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for step in range(3):
        spark.range(step * 10, step * 10 + 10).write.mode("append").parquet(folder)
        counts = spark.readStream.schema("id long").parquet(folder).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
        write_stream(counts, batch_files(out + "/rows"), out + "/checkpoint", mode="update").awaitTermination()
    assert rows(latest_state(read_batches(spark, out + "/rows"), ["k"], ["n"])) == [(0, 10), (1, 10), (2, 10)]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    sink = batch_files(str(tmp_path / "rows"))
    for _ in range(2):
        sink(spark.range(5), 7)
    assert read_batches(spark, str(tmp_path / "rows")).count() == 5


def test_generated_stream(spark, tmp_path):
    stream = generate_stream(spark, "goods", 5, seed=3)
    out = str(tmp_path / "g")
    query = write_stream(stream, batch_files(out + "/rows"), out + "/checkpoint", once=True)
    query.awaitTermination()
    got = read_batches(spark, out + "/rows")
    assert got.count() == 5 and got.where("n < 100 OR n >= 200").count() == 0


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)


def sides(df):
    left = df.where("event_type IN ('view', 'flush')").select("user_id", F.col("event_id").alias("l_id"), F.col("ts").alias("l_ts"))
    right = df.where("event_type IN ('purchase', 'flush')").select("user_id", F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"))
    return left, right


def test_window_left_join(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, window_join_stream(*sides(stream()), ["user_id"], "l_ts", "r_ts", "1 day", 0, "left"), tmp_path)
    want = joins.window_join(*sides(data), ["user_id"], "l_ts", "r_ts", 24 * HOUR, "left")
    columns = ["user_id", "l_id", "r_id", "w_start"]
    assert rows(got.where("user_id >= 0"), *columns) == rows(want, *columns)


def test_followed_by_join_times_out(spark, feed, tmp_path):
    data, stream = feed
    got = run(spark, followed_by_stream(*sides(stream()), ["user_id"], "l_ts", "r_ts", "24 HOURS", 0), tmp_path)
    is_type = lambda name: lambda row, *_: row("event_type") == name
    pattern = Pattern.begin("a", is_type("view")).followed_by("b", is_type("purchase")).within(24 * HOUR)
    want = match(data, ["user_id"], ["event_id"], "ts", pattern, ["event_id"])
    first = got.where("user_id >= 0").groupBy("l_id").agg(F.min("r_id").alias("r_id"))
    assert rows(first) == rows(want, "a.event_id", "b.event_id")


def test_rules_are_read_again_for_every_batch(spark, tmp_path):
    rules_path, out, folder = (str(tmp_path / n) for n in ("rules", "out", "in"))

    def sink(batch, batch_id):
        joined = rules.apply_rules_batch(batch, rules_path, F.col("d.id") % 2 == F.col("r.k"))
        joined.select("d.id", "r.topic").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for step, topic in enumerate(("old", "new")):
        spark.createDataFrame([(0, topic)], "k long, topic string").write.mode("overwrite").parquet(rules_path)
        spark.range(step * 2, step * 2 + 2).write.mode("append").parquet(folder)
        write_stream(spark.readStream.schema("id long").parquet(folder), sink, str(tmp_path / "cp")).awaitTermination()
    assert rows(read_batches(spark, out), "id", "topic") == [(0, "old"), (1, None), (2, "new"), (3, None)]
