"""Hand-computed results of the small worked examples."""

from pyspark.sql import functions as F

from brooklet.functions import parsing, scalars
from brooklet.operators import aggregates, routing, stateful, windows
from brooklet.operators.ordered import Sum
from brooklet.operators.patterns import Pattern, match
from brooklet.sources.files import sequence
from tests.conftest import rows


def numbered(spark, data, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "o long, " + schema)


def in_order(df, *columns):
    return [tuple(r) for r in df.orderBy("o").select(*columns).collect()]


def test_word_count(spark):
    lines = spark.createDataFrame([("to be or not to be",), ("not so",)], "value string")
    counts = aggregates.count_by(parsing.words(lines, "value"), ["word"])
    assert rows(counts) == [("be", 2), ("not", 2), ("or", 1), ("so", 1), ("to", 2)]


def test_words_drop_trailing_blanks_only(spark):
    lines = spark.createDataFrame([(1, " a  b  "), (2, ""), (3, "  ")], "id int, value string")
    got = parsing.words(lines, "value", keep=("id",))
    assert rows(got) == [(1, ""), (1, ""), (1, "a"), (1, "b"), (2, "")]
    assert rows(parsing.words(lines, "value", keep=("id",), skip_blank=True).where("word <> ''")) == [(1, "a"), (1, "b")]


def test_running_reduce_keeps_the_first_row(spark):
    data = [("north", "apples", 7), ("south", "pears", 40), ("north", "plums", 5), ("south", "apples", 2), ("north", "pears", 11)]
    got = aggregates.running_reduce(numbered(spark, data, "shop string, fruit string, crates int"), ["shop"], ["o"], "crates", "fruit", "total")
    assert in_order(got, "shop", "fruit", "crates") == [
        ("north", "apples", 7), ("south", "pears", 40), ("north", "total", 12), ("south", "total", 42), ("north", "total", 23),
    ]


def test_running_best_and_reduce(spark):
    data = [("red", "oak", 9), ("blue", "elm", 14), ("red", "ash", 3), ("red", "fir", 20), ("blue", "yew", 13), ("green", "elm", 1)]
    trees = numbered(spark, data, "plot string, tree string, metres int")
    best = aggregates.running_best(trees, ["plot"], ["o"], "metres", "max", ["tree", "metres"])
    assert in_order(best, "plot", "best_tree", "best_metres") == [
        ("red", "oak", 9), ("blue", "elm", 14), ("red", "oak", 9), ("red", "fir", 20), ("blue", "elm", 14), ("green", "elm", 1),
    ]
    reduced = aggregates.running_reduce(trees, ["plot"], ["o"], "metres", "tree", "all")
    assert in_order(reduced, "plot", "tree", "metres") == [
        ("red", "oak", 9), ("blue", "elm", 14), ("red", "all", 12), ("red", "all", 32), ("blue", "all", 27), ("green", "elm", 1),
    ]


def test_best_keeps_the_earlier_of_equals(spark):
    data = numbered(spark, [("k", "a", 5), ("k", "b", 5), ("k", "c", 1), ("k", "d", 1)], "k string, v string, n int")
    assert in_order(aggregates.running_best(data, ["k"], ["o"], "n", "max", ["v"]), "best_v") == [("a",)] * 4
    assert rows(aggregates.final_best(data, ["k"], ["o"], "n", "min", ["v"])) == [("k", "c")]


def test_running_sum_and_cleared_state(spark):
    data = [("x", 10), ("y", -4), ("y", 6), ("x", 7), ("z", 0), ("y", 9)]
    ints = numbered(spark, data, "k string, n int")
    assert in_order(aggregates.running(ints, ["k"], ["o"], total=Sum("n")), "k", "total") == [
        ("x", 10), ("y", -4), ("y", 2), ("x", 17), ("z", 0), ("y", 11),
    ]
    assert in_order(stateful.value_sum(ints, "n"), "k", "total") == data


def test_connect_two_types(spark):
    got = routing.connect(
        sequence(spark, 0, 10),
        spark.createDataFrame([("some text",)], "value string"),
        lambda n: n.select(F.concat(F.lit("number "), F.col("n").cast("string")).alias("value")),
        lambda s: s,
    )
    assert rows(got) == sorted([(f"number {i}",) for i in range(11)] + [("some text",)], key=repr)


def test_bounce_window_decides(spark):
    data = [("v1", "shop", None, 500), ("v2", "shop", None, 1000), ("v2", "cart", "shop", 4000), ("v2", "help", "cart", 90000)]
    views = numbered(spark, data, "mid string, page string, last string, ts long").withColumn("ts", F.timestamp_millis("ts"))
    start = lambda r: r("last").isNull()

    def bounced(ms):
        pattern = Pattern.begin("start", start).next("second", lambda r: r("last").isNotNull()).within(ms)
        return rows(match(views, ["mid"], ["o"], "ts", pattern, ["page"]).where("outcome = 'timeout'"), "mid", "start.page")

    assert bounced(20_000) == [("v1", "shop")]
    assert bounced(1) == [("v1", "shop"), ("v2", "shop")]
    assert bounced(3_000) == [("v1", "shop"), ("v2", "shop")]
    assert bounced(3_001) == [("v1", "shop")]


def test_segments(spark):
    words = "| one two three | four | | five six".split()
    data = numbered(spark, [("k", w) for w in words], "k string, w string")
    got = stateful.delimited_segments(data, ["k"], ["o"], "w", F.col("w") == "|")
    assert (1, "four") in rows(got, "n", "text") and (3, "one two three") in rows(got, "n", "text")
    assert "five" not in " ".join(r[1] for r in rows(got, "n", "text"))


def test_running_distinct(spark):
    data = numbered(spark, [("sale", "web", "kim"), ("sale", "web", "lou"), ("sale", "app", "kim"), ("sale", "web", "kim")], "what string, via string, who string")
    got = aggregates.running_distinct(data, ["what", "via"], "who", ["o"])
    assert in_order(got, "via", "users", "clicks") == [("web", 1, 1), ("web", 2, 2), ("app", 1, 1), ("web", 2, 3)]


def test_top_two_counts_duplicates(spark):
    got = aggregates.top_n(spark.createDataFrame([(7,), (7,), (3,)], "v int"), "v", 2)
    assert rows(got, "v", "rank") == [(7, 1), (7, 2)]


def test_java_hash(spark):
    df = spark.createDataFrame([("hello",), ("",), ("中文",), ("😀",)], "s string")
    got = dict(df.select("s", scalars.java_hash(F.col("s"))).collect())
    assert got == {"hello": 99162322, "": 0, "中文": 646394, "😀": 1772899}
    assert df.where((scalars.key_partition(F.col("s"), 7) < 0) | (scalars.key_partition(F.col("s"), 7) > 6)).count() == 0


def test_stuck_total_counts_windows(spark):
    data = numbered(spark, [("k", 0), ("k", 1000), ("k", 7000), ("k", 8000), ("k", 60000)], "k string, ms long")
    got = windows.stuck_total(data.withColumn("ts", F.timestamp_millis("ms")), "ts", 5000, ["k"], ["o"])
    assert in_order(got, "total") == [(1,), (1,), (2,), (2,), (3,)]


def test_inactivity_tie(spark):
    data = numbered(spark, [("w", 0), ("w", 10_000), ("w", 19_999)], "w string, ms long").withColumn("ts", F.timestamp_millis("ms"))
    got = stateful.inactivity(data, ["w"], ["o"], "ts", 10_000)
    assert in_order(got, "total", "fired_ms") == [(1, 10_000), (3, 29_999)]


def test_malformed_lines(spark):
    lines = spark.createDataFrame([("a,1",), ("a",), ("a,x",), ("",), ("a,1,2",), (",2",)], "line string")
    got = parsing.split_fields(lines, "line", ",", "k string, n int")
    assert rows(routing.select_output(got, "ok"), "k", "n") == [("", 2), ("a", 1)]
    assert got.where("tag = 'bad'").count() == 4


def test_empty_input(spark, tiny_slices):
    empty = spark.createDataFrame([], "k string, o long, v double")
    assert aggregates.running(empty, ["k"], ["o"], t=Sum("v")).count() == 0
    assert aggregates.running(empty, [], ["o"], t=Sum("v")).count() == 0
