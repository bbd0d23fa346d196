"""Streams whose rows arrive out of order, in many micro-batches, against the batch forms."""

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from brooklet.operators import machines, rules, stateful
from brooklet.operators.patterns import Pattern, match
from brooklet.streaming import processors
from brooklet.streaming.compare import compiled
from brooklet.streaming.exactly_once import read_batches, tagged_files, write_stream
from brooklet.streaming.held import Held
from brooklet.streaming.patterns import match_stream
from brooklet.streaming.processors import with_previous_stream
from brooklet.streaming.rules import RuleLog, block_listed_stream, matching_rule_stream
from tests.conftest import rows
from tests.test_streaming import run

DELAY = 30_000
SCHEMA = "k int, o int, w string, v double, ip string, ts timestamp"
EPOCH = 1_700_000_000


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Every partition of every micro-batch starts a worker."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Rows a second or so apart, each up to 29 seconds late, in 6 files, then one row that ends all waiting."""
    rng = random.Random(11)
    made, at = [], 0.0
    for o in range(300):
        at += rng.choice([0, 0, 0.0005, 0.5, 1, 2, 9])
        made.append((rng.randrange(3), o, rng.choice(["go", "end", "fail", "ok", None]), rng.choice([1.0, 2.0, 3.0, None]), f"10.0.0.{rng.randrange(3)}", at))
    arrival = sorted(made, key=lambda r: r[5] + rng.uniform(0, 29))
    folder = str(tmp_path_factory.mktemp("shuffled"))

    def frame(part):
        plain = spark.createDataFrame([(*r[:5], float(r[5])) for r in part], "k int, o int, w string, v double, ip string, s double")
        return plain.withColumn("ts", F.timestamp_micros(F.round(F.col("s") * 1_000_000).cast("long") + EPOCH * 1_000_000)).drop("s")

    for i in range(0, 300, 50):
        frame(arrival[i : i + 50]).coalesce(1).write.mode("append").parquet(folder)
    late = (9, 10_000, "flush", 0.0, "x", 10.0**7)
    for _ in range(2):
        frame([late]).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return frame(made).cache(), stream


def is_(name):
    return lambda r, *_: r("w") == name


PATTERNS = {
    "followed": Pattern.begin("a", is_("go")).followed_by("b", is_("end")).within(20_000),
    "strict": Pattern.begin("a", is_("go")).next("b", lambda r: r("v") > 1).next("c", lambda r: r("v") < 3).within(15_000),
    "mixed": Pattern.begin("a", lambda r: r("v") > 1).next("b", is_("fail")).followed_by("c", is_("ok")).within(40_000),
    "start": Pattern.begin("a", lambda r: r("v") > 0).next("b", lambda r, s: (r("ip") != s("ip")) & (r("v") >= s("v")), uses_start=True).within(5_000),
    "start twice": Pattern.begin("a", is_("go")).next("b", lambda r, s: r("ip") == s("ip"), uses_start=True).next("c", lambda r, s: r("v") - s("v") > 0, uses_start=True).within(60_000),
}


@pytest.mark.parametrize("name", PATTERNS)
def test_patterns_out_of_order(spark, shuffled, tmp_path, name):
    data, stream = shuffled
    columns = ["o", "v", "ip", "ts"]
    got = run(spark, match_stream(stream(), ["k"], ["o"], "ts", PATTERNS[name], columns, DELAY), tmp_path).where("k < 9")
    want = match(data, ["k"], ["ts", "o"], "ts", PATTERNS[name], columns)
    shown = ["k", "outcome", *[f"{s.name}.{c}" for s in PATTERNS[name].steps for c in ("o", "v", "ts")]]
    assert rows(got, *shown) == rows(want, *shown) != []


def test_a_follower_that_is_earlier_is_no_follower(spark, tmp_path):
    data = [(1, 0, "go", 100), (1, 1, "end", 95), (9, 2, "x", 10**6), (9, 3, "x", 10**6)]
    df = spark.createDataFrame(data, "k int, o int, w string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + EPOCH))
    for o in range(4):
        df.where(F.col("o") == o).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    pattern = Pattern.begin("a", is_("go")).followed_by("b", is_("end")).within(10_000)
    got = run(spark, match_stream(stream, ["k"], ["o"], "ts", pattern, ["o"], DELAY), tmp_path)
    assert rows(got, "k", "outcome", "a.o", "b.o") == [(1, "timeout", 0, None)]


def test_machines_out_of_order(spark, shuffled, tmp_path):
    data, stream = shuffled
    rising = machines.RisingAlert(6_000)
    got = run(spark, processors.run_machine(stream().withColumnRenamed("v", "value"), ["k"], ["o"], "ts", rising, DELAY), tmp_path / "rising").where("k < 9")
    want = machines.rising_alert(data.where("v IS NOT NULL"), ["k"], ["ts", "o"], "ts", "v", 6_000)
    nulls = data.where("v IS NULL").count()
    assert nulls > 0 and rows(got, "k", "at_ms", "value") != []
    clean = run(spark, processors.run_machine(stream().where("v IS NOT NULL").withColumnRenamed("v", "value"), ["k"], ["o"], "ts", rising, DELAY), tmp_path / "clean").where("k < 9")
    assert rows(clean, "k", "at_ms", "value") == rows(want, "k", "at_ms", "value")

    failed = F.when(F.col("w") == "fail", True).when(F.col("w") == "ok", False)
    marked = stream().withColumn("failed", F.coalesce(failed, F.when(F.col("k") == 9, False))).where("failed IS NOT NULL")
    got = run(spark, processors.run_machine(marked, ["k"], ["o"], "ts", machines.FailBurst(9_000, 2), DELAY), tmp_path / "burst")
    want = machines.fail_burst(data, ["k"], ["ts", "o"], "ts", F.col("w") == "fail", F.col("w") == "ok", 9_000)
    assert rows(got, "k", "at_ms", "fails") == rows(want, "k", "at_ms", "fails") != []


def sided(df):
    side = F.when(F.col("w").isin("go", "end"), "left").when(F.col("w").isin("fail", "ok", "flush"), "right")
    return df.withColumns({"src": side, "n": F.col("v")}).where("src IS NOT NULL AND n IS NOT NULL")


def test_pair_sums_out_of_order(spark, shuffled, tmp_path):
    data, stream = shuffled
    got = run(spark, processors.run_machine(sided(stream()), ["k"], ["o"], "ts", machines.PairSum(4_000), DELAY), tmp_path).where("k < 9")
    both = sided(data)
    want = machines.pair_sum(both.where("src = 'left'"), both.where("src = 'right'"), ["k"], ["ts", "o"], "ts", "v", 4_000)
    assert rows(got, "k", "at_ms", "kind", "total") == rows(want, "k", "at_ms", "kind", "total") != []


def test_idle_keys_leave_the_store(spark, shuffled, tmp_path):
    _, stream = shuffled
    pattern = PATTERNS["followed"]
    query = write_stream(match_stream(stream(), ["k"], ["o"], "ts", pattern, ["o"], DELAY), tagged_files(str(tmp_path / "out"), ["none"], "outcome"), str(tmp_path / "cp"))
    query.awaitTermination()
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    # Only the row that ended all waiting still waits, with its alarm.
    assert kept <= 5, json.dumps(query.lastProgress["stateOperators"], default=str)


def test_segments_out_of_order(spark, shuffled, tmp_path):
    data, stream = shuffled
    delimiter = F.col("w") == "end"
    got = run(spark, processors.delimited_segments_stream(stream(), ["k"], ["o"], "ts", "ip", delimiter, DELAY), tmp_path).where("k < 9")
    want = stateful.delimited_segments(data, ["k"], ["ts", "o"], "ip", delimiter)
    assert rows(got, "k", "segment", "n", "text") == rows(want, "k", "segment", "n", "text") != []


@pytest.mark.parametrize("idle", [2_000, 9_000])
def test_inactivity_out_of_order(spark, shuffled, tmp_path, idle):
    data, stream = shuffled
    got = run(spark, processors.inactivity_stream(stream(), ["k"], ["o"], "ts", idle, DELAY), tmp_path).where("k < 9")
    want = stateful.inactivity(data, ["k"], ["ts", "o"], "ts", idle)
    columns = ["k", "o", "w", "v", "ts", "total", "fired_ms"]
    assert rows(got, *columns) == rows(want, *columns) != []


def control(df):
    """Rules from some of the rows themselves; the last row stands for a control stream that has moved on."""
    chosen = F.when(F.col("o") % 2 == 0, F.array(F.lit("go"), F.lit("ok"))).otherwise(F.array(F.lit("fail")))
    topic = F.concat(F.lit("t"), (F.col("o") % 5).cast("string"))
    picked = df.where("o % 23 = 7 OR k = 9").select("ts", "o", chosen.alias("words"), F.when(F.col("o") % 2 == 0, "go").otherwise("ok").alias("first_action"), F.lit("fail").alias("second_action"), topic.alias("topic"))
    return picked


@pytest.mark.parametrize("first", ["rules", "records"])
def test_rules_in_force(spark, shuffled, tmp_path, first):
    """Whichever stream is ahead, each record sees the rule of its time."""
    data, stream = shuffled
    records = lambda df: df.select("ts", "o", "k", "w")
    log = RuleLog(str(tmp_path / "rules"), control(data).schema, "ts", "o", DELAY)
    held = Held(str(tmp_path / "held"), records(data).schema)
    sink = block_listed_stream(log, held, "w", "words", ["end"], tagged_files(str(tmp_path / "out"), ["blocked", "passed"]))
    read_rules = lambda: write_stream(control(stream()), log.append, str(tmp_path / "cp-rules")).awaitTermination()
    own = str(tmp_path / "in")
    data.repartition(3).write.parquet(own)  # in any order: only rules must not be later than the delay
    arriving = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(own)
    read_records = lambda: write_stream(records(arriving()), sink, str(tmp_path / "cp")).awaitTermination()
    if first == "rules":
        read_rules()
        read_records()
    else:
        read_records()
        assert glob.glob(f"{tmp_path}/out/*/*/*.parquet") == []  # all held: no rule is known yet
        read_rules()
        data.limit(1).withColumns({"k": F.lit(9), "o": F.lit(20_000)}).write.mode("append").parquet(own)
        read_records()
    got = read_batches(spark, str(tmp_path / "out")).where("k < 9")
    want = rules.block_listed(records(data), control(data), "ts", "o", "w", "words", ["end"])
    columns = ["o", "w", F.array_join("word_set", ",").alias("words"), "tag"]
    assert rows(got, *columns) == rows(want, *columns) != []
    assert rows(got.where("tag = 'blocked'")) != []


def test_keyed_rules(spark, shuffled, tmp_path):
    data, stream = shuffled
    log = RuleLog(str(tmp_path / "rules"), control(data).schema, "ts", "o", DELAY)
    records = with_previous_stream(stream().select("ts", "o", "k", "w"), ["k"], ["o"], "ts", "w", "prev_action", DELAY)
    held = Held(str(tmp_path / "held"), records.schema)

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    write_stream(control(stream()), log.append, str(tmp_path / "cp-rules")).awaitTermination()
    write_stream(records, matching_rule_stream(log, held, "w", "first_action", "second_action", ["topic"], keep), str(tmp_path / "cp")).awaitTermination()
    got = read_batches(spark, str(tmp_path / "out")).where("k < 9")
    want = rules.matching_rule(data.select("ts", "o", "k", "w"), control(data), "ts", "o", ["k"], "w", "first_action", "second_action", ["topic"])
    columns = ["o", "k", "w", "prev_action", "topic"]
    assert rows(got, *columns) == rows(want, *columns) != []


def test_compiled_conditions_follow_sql(spark):
    cases = [(a, b) for a in (1, 2, None) for b in (1, 2, None)]
    conditions = [
        lambda r, s: r("x") == s("x"), lambda r, s: ~(r("x") == s("x")), lambda r, s: (r("x") > 1) | (s("x") > 1), lambda r, s: (r("x") != 2) & (s("x") <= 2),
        lambda r, s: r("x").isNull() | (r("x") + s("x") * 2 - 1 >= 4), lambda r, s: s("x").isNotNull() & (r("x") < s("x")),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a int, b int")
    for condition in conditions:
        hits = {r.i for r in df.where(condition(lambda _: F.col("a"), lambda _: F.col("b"))).collect()}
        own = compiled(condition)
        assert {i for i, (a, b) in enumerate(cases) if own({"x": a}, {"x": b})} == hits
    with pytest.raises(ValueError):
        compiled(lambda r, s: True)
