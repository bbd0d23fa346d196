"""Whole streaming jobs: windows with lateness, the flagship, two-phase output, paced replay, bounded state."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.bloom import Bloom
from brooklet.operators import aggregates, eventtime, windows
from brooklet.plans.join_queries import order_streams
from brooklet.plans.order_enrich import enrich_orders
from brooklet.plans.registry import Tables
from brooklet.sinks.two_phase import read_committed, sweep, two_phase
from brooklet.sources.log import decode_log
from brooklet.sources.replay import replay_stream
from brooklet.streaming import processors
from brooklet.streaming.exactly_once import batch_files, read_batches, write_stream
from brooklet.streaming.lateness import tumble_with_lateness_stream
from brooklet.streaming.order_enrich import both_streams, enrich_orders_stream
from tests.conftest import DATA, rows
from tests.test_streaming import run


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Every partition of every micro-batch starts a worker."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_windows_fire_update_and_drop(spark, tmp_path):
    # (arrival, key, second, value): windows of 10 s, delay 2 s, lateness 6 s
    plain = [(0, "a", 1, 1.0), (1, "a", 9, 2.0), (2, "b", 4, 4.0), (3, "a", 13, 1.5), (4, "a", 3, 8.0), (5, "b", 8, None), (6, "a", 19, 1.0), (7, "a", 7, 3.0), (8, "b", 27, 1.0), (9, "a", 2, 9.0), (10, "a", 18, 5.0), (11, "b", 21, 2.0), (12, "a", 40, 1.0), (13, "b", 12, 7.0)]
    data = spark.createDataFrame(plain, "arrival long, k string, s long, value double").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).drop("s")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    end = spark.createDataFrame([(100, "z", 10**6, 0.0)], "arrival long, k string, s long, value double").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).drop("s")
    for i in range(len(plain)):
        data.where(F.col("arrival") == i).coalesce(1).write.mode("append").parquet(folder)
    end.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    fired = tumble_with_lateness_stream(stream, "ts", ["arrival"], 2_000, 10_000, 6_000, ["k"], "value")
    want = rows(eventtime.tumble_with_lateness(data, "ts", ["arrival"], 2_000, 10_000, 6_000, ["k"], "value"))
    assert {r[-1] for r in want} == {"fire", "update", "late"}
    query = write_stream(fired, batch_files(out + "/rows"), out + "/checkpoint", processingTime="0 seconds")
    deadline, got = time.time() + 120, []
    while len(got) < len(want) and time.time() < deadline:
        time.sleep(2)
        if os.path.isdir(out + "/rows"):
            got = rows(read_batches(spark, out + "/rows").where("k <> 'z'").drop("batch_id"))
    query.stop()
    assert got == want


def test_order_details_are_enriched_on_streams(spark, tmp_path):
    details, mains, orders = order_streams(Tables(spark, DATA))
    few = F.col("line") % 7 == 0
    details, orders = details.where(few).cache(), orders.cache()
    folders = {}
    for name, df, by in (("detail", details, "arrived"), ("main", mains.cache(), "arrived")):
        folders[name] = str(tmp_path / name)
        cuts = df.select(F.percentile(by, [0.25, 0.5, 0.75]).alias("p")).first().p
        edges = [float("-inf"), *cuts, float("inf")]
        for low, high in zip(edges, edges[1:]):
            df.where((F.col(by) > low) & (F.col(by) <= high)).coalesce(1).write.mode("append").parquet(folders[name])
        # One more row far in the future ends all windows.
        last = df.orderBy(F.col(by).desc()).limit(1)
        born = F.timestamp_millis(F.lit(4_000_000_000_000))
        kind = "array<struct<id:long,order_id:long,sku:long,supplier:long,amount:int,money:double,create_time:timestamp>>" if name == "detail" else "array<struct<oid:long,create_time:timestamp,total_money:double,status:string,province:string>>"
        made = last.withColumn("data", F.from_json(F.get_json_object("envelope", "$.data"), kind))
        made = made.withColumn("data", F.transform("data", lambda d: d.withField("create_time", born)))
        made = made.withColumn("envelope", F.to_json(F.struct(F.lit("INSERT").alias("type"), "data"))).drop("data").withColumn("arrived", F.lit(4_000_000_000_000))
        made.coalesce(1).write.mode("append").parquet(folders[name])
    arrival = ["arrived", "line", "l_partkey", "l_suppkey"], ["arrived", "o_orderkey"]
    streams = [spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folders[n]) for n, df in (("detail", details), ("main", mains))]
    out = str(tmp_path / "out")
    sink = enrich_orders_stream(lambda: orders, *arrival, str(tmp_path / "held"), batch_files(out))
    write_stream(both_streams(*streams), sink, str(tmp_path / "cp")).awaitTermination()
    got = read_batches(spark, out).where("create_time < '2090-01-01'")
    want = enrich_orders(details, mains, orders, *arrival)
    columns = ["id", "sku", "supplier", "change", "via", "total_money", "status"]
    assert rows(got, *columns) == rows(want, *columns)
    assert {r[0] for r in rows(got.select("via").distinct())} == {"window", "miss", "late"}


@pytest.fixture
def numbered(spark, tmp_path):
    folder = str(tmp_path / "in")
    for step in range(3):
        spark.range(step * 100, step * 100 + 100).repartition(3).write.mode("append").parquet(folder)
    return folder


def committed(spark, path):
    return rows(read_committed(spark, path, T.StructType.fromDDL("id long")))


def test_failed_epochs_leave_nothing(spark, numbered, tmp_path):
    out, poison = str(tmp_path / "out"), str(tmp_path / "poison")

    @F.udf("long")
    def checked(n):
        if os.path.exists(poison) and n == 250:
            raise ValueError("poisoned")
        return n

    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 3).parquet(numbered).select(checked("id").alias("id"))
    open(poison, "w").close()
    query = two_phase(stream(), out, str(tmp_path / "cp")).start()
    with pytest.raises(Exception, match="poisoned"):
        query.awaitTermination()
    before = committed(spark, out)
    assert len(before) < 300 and (250,) not in before
    sweep(out, older_than_s=0)
    listed = {f["name"] for e in glob.glob(out + "/epochs/*.json") for f in json.load(open(e))["files"]}
    assert {os.path.basename(f) for f in glob.glob(out + "/files/*.parquet")} == listed
    os.remove(poison)
    two_phase(stream(), out, str(tmp_path / "cp")).start().awaitTermination()
    assert committed(spark, out) == sorted([(i,) for i in range(300)], key=repr)


def test_replayed_epochs_add_nothing(spark, numbered, tmp_path):
    out, checkpoint = str(tmp_path / "out"), tmp_path / "cp"
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 3).parquet(numbered)
    two_phase(stream(), out, str(checkpoint)).start().awaitTermination()
    files = sorted(glob.glob(out + "/files/*"))
    last = max(int(os.path.basename(f)) for f in glob.glob(str(checkpoint / "commits/*")) if os.path.basename(f).isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    two_phase(stream(), out, str(checkpoint)).start().awaitTermination()
    assert committed(spark, out) == sorted([(i,) for i in range(300)], key=repr)
    assert sorted(glob.glob(out + "/files/*")) == files


def test_two_streams_share_a_folder(spark, numbered, tmp_path):
    out = str(tmp_path / "out")
    for name in ("one", "two"):
        two_phase(spark.readStream.schema("id long").parquet(numbered), out, str(tmp_path / name), writer=name).start().awaitTermination()
    assert len(committed(spark, out)) == 600


SCHEMA = "topic string, partition int, offset long, key binary, value binary"


def log_table(spark, path, n=500):
    made = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("topic"), (F.col("id") % 5 % 2).cast("int").alias("partition"), F.col("id").alias("offset"),
        F.col("id").cast("string").cast("binary").alias("key"), F.to_json(F.struct((F.col("id") * 3).alias("k"))).cast("binary").alias("value"),
    )
    made.repartition("topic", "partition").sortWithinPartitions("topic", "partition", "offset").write.partitionBy("topic", "partition").parquet(path)
    return made


def test_log_partitions_are_read_by_offset_and_go_on_after_a_stop(spark, tmp_path):
    table, out = str(tmp_path / "log"), str(tmp_path / "out")
    made = log_table(spark, table)
    start = lambda: decode_log(replay_stream(spark, table, SCHEMA, str(tmp_path / "progress"), rows_per_batch=30), "k long")
    query = write_stream(start(), batch_files(out), str(tmp_path / "cp"), processingTime="0 seconds")
    deadline = time.time() + 60
    while len(query.recentProgress) < 2 and time.time() < deadline:
        time.sleep(0.2)
    query.stop()
    first = read_batches(spark, out)
    count = first.count()
    assert 0 < count < 500
    sizes = rows(first.groupBy("batch_id", "topic", "partition").count().select("count").distinct())
    assert max(n for (n,) in sizes) <= 30
    query = write_stream(start(), batch_files(out), str(tmp_path / "cp"), processingTime="0 seconds")
    while time.time() < deadline + 60 and read_batches(spark, out).count() < 500:
        time.sleep(0.5)
    query.stop()
    got = read_batches(spark, out)
    columns = ["topic", "partition", "offset", "k"]
    assert rows(got, *columns) == rows(decode_log(made, "k long"), *columns)
    # Each partition in order, over the batches.
    for key in ({"topic": "a", "partition": 0}, {"topic": "b", "partition": 1}):
        own = [(r.batch_id, r.offset) for r in got.where(F.col("topic") == key["topic"]).where(F.col("partition") == key["partition"]).collect()]
        by_batch = sorted(own)
        assert [o for _, o in by_batch] == sorted(o for _, o in own)


def test_replay_keeps_its_pace(spark, tmp_path):
    table, out = str(tmp_path / "rows"), str(tmp_path / "out")
    spark.range(5_000).coalesce(1).write.parquet(table)
    began = time.time()
    query = write_stream(replay_stream(spark, table, "id long", str(tmp_path / "progress"), rows_per_second=100), batch_files(out), str(tmp_path / "cp"), processingTime="0 seconds")
    time.sleep(6)
    query.stop()
    took = time.time() - began
    n = read_batches(spark, out).count()
    assert 0 < n <= 100 * took
    assert rows(read_batches(spark, out), "id") == sorted([(i,) for i in range(n)], key=repr)


@pytest.fixture
def in_files(spark, events, tmp_path):
    folder = str(tmp_path / "feed")
    data = events.select("event_id", "user_id", "event_type", "value").cache()
    top = data.agg(F.max("event_id")).first()[0]
    for part in range(4):
        data.where((F.col("event_id") * 4 >= part * (top + 1)) & (F.col("event_id") * 4 < (part + 1) * (top + 1))).coalesce(1).write.mode("append").parquet(folder)
    return data, lambda: spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_distinct_counts_in_bounded_state(spark, in_files, tmp_path):
    data, stream = in_files
    bloom = Bloom(2_000, 0.01)
    got = run(spark, processors.running_distinct_stream(stream(), ["event_type"], "user_id", ["event_id"], bloom), tmp_path)
    want = aggregates.running_distinct(data, ["event_type"], "user_id", ["event_id"])
    both = got.select("event_id", F.col("users").alias("about"), F.col("clicks").alias("c")).join(want, "event_id")
    worst = both.agg(F.max(F.abs(F.col("users") - F.col("about")) / F.col("users")), F.max(F.abs(F.col("clicks") - F.col("c")))).first()
    assert both.count() == data.count() and worst[0] <= 0.02 and worst[1] == 0


def test_bloom_error_and_size():
    bloom = Bloom(20_000, 0.01)
    pages = [Bloom.empty() for _ in range(bloom.pages)]
    taken = 0
    for i in range(20_000):
        page, bits = bloom.place(f"user {i}")
        taken += not Bloom.add(pages[page], bits)
    assert taken / 20_000 < 0.01
    wrong = sum(not Bloom.add(bytearray(pages[p]), bits) for p, bits in (bloom.place(f"other {i}") for i in range(20_000)))
    assert wrong / 20_000 < 0.01
    assert 20_000 * 9.6 < bloom.pages * (1 << 15) < 20_000 * 15
    assert all(not Bloom.add(pages[p], bits) for p, bits in (bloom.place(f"user {i}") for i in range(20_000)))
    assert Bloom(10_000_000, 0.01).pages * 4096 < 16_000_000


def test_merged_filters_know_both_sides():
    bloom = Bloom(500, 0.01)
    sides = [[Bloom.empty() for _ in range(bloom.pages)] for _ in range(2)]
    for side, pages in enumerate(sides):
        for i in range(250):
            page, bits = bloom.place(f"{side} {i}")
            Bloom.add(pages[page], bits)
    merged = [bytearray(Bloom.merge(bytes(a), bytes(b))) for a, b in zip(*sides)]
    assert not any(Bloom.add(merged[p], bits) for p, bits in (bloom.place(f"{s} {i}") for s in range(2) for i in range(250)))


@pytest.mark.parametrize("size, slide", [(10, 2), (6, 6), (9, 3)])
def test_count_windows_by_partials(spark, in_files, tmp_path, size, slide):
    data, stream = in_files
    data = data.withColumn("value", F.when(F.col("event_id") % 9 != 0, F.col("value")))
    with_null = stream().withColumn("value", F.when(F.col("event_id") % 9 != 0, F.col("value")))
    got = run(spark, processors.count_slide_stream(with_null, ["user_id"], ["event_id"], size, slide, "value"), tmp_path)
    v = F.col("value")
    want = windows.count_slide(data, ["user_id"], ["event_id"], size, slide, F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"))
    shown = ["user_id", "fire", "n", F.round("total", 6).alias("total"), "low", "high"]
    assert rows(got, *shown) == rows(want, *shown)
    parts = {"c": F.count(v), "s": F.sum(v), "l": F.min(v), "h": F.max(v)}
    merged = windows.count_slide_partials(data, ["user_id"], ["event_id"], size, slide, parts, {"n": F.sum("c"), "total": F.sum("s"), "low": F.min("l"), "high": F.max("h")})
    assert rows(merged, *shown) == rows(want, *shown)
