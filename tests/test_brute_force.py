"""State machines and ordered scans against straightforward simulations, on random keys, gaps and ties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brooklet.operators import joins, machines, pairs
from brooklet.operators.ordered import Count, History, Last, Max, Min, Next, Ordered, Sum
from tests.conftest import rows

TIMEOUT = 10


def random_rows(seed, n=400, keys=5):
    """(o, k, ms, src, value): the first key holds about half of the rows; some rows share a millisecond."""
    rnd, ms, out = random.Random(seed), 0, []
    for o in range(n):
        ms += rnd.choice([0, 1, 1, 2, 3, 9, 10, 11, 25]) if rnd.random() < 0.7 else 1
        key = 0 if rnd.random() < 0.5 else rnd.randrange(keys)
        out.append((o, key, ms, rnd.choice(["left", "right"]), float(rnd.randrange(6))))
    return out


def frame(spark, data):
    df = spark.createDataFrame(data, "o long, k long, ms long, src string, value double")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def by_key(data):
    for key in sorted({r[1] for r in data}):
        yield key, [r for r in data if r[1] == key]


def simulate_pairs(data, clears, adds):
    out = []
    for key, items in by_key(data):
        held, timers, latest = {}, set(), None

        def fire(limit):
            for at in sorted(t for t in timers if limit is None or t <= limit):
                timers.discard(at)
                for side in ("left", "right"):
                    if side in held:
                        out.append((key, at, side, held[side]))
                if clears:
                    held.clear()

        for _, _, ms, src, value in items:
            fire(ms)
            other = "right" if src == "left" else "left"
            if other in held:
                out.append((key, ms, "sum", value + held[other]))
                timers.discard(latest)
                held.clear()
            else:
                held[src] = value + (held.get(src, 0.0) if adds else 0.0)
                latest = ms + TIMEOUT
                timers.add(latest)
        fire(None)
    return sorted(out, key=repr)


def simulate_rising(data):
    out = []
    for key, items in by_key(data):
        last, timer = None, None
        for _, _, ms, _, value in items:
            if timer is not None and timer <= ms:
                out.append((key, timer, last))
                timer = None
            if last is not None and value > last and timer is None:
                timer = ms + TIMEOUT
            elif last is not None and value < last:
                timer = None
            last = value
        if timer is not None:
            out.append((key, timer, last))
    return sorted(out, key=repr)


def simulate_fails(data):
    out = []
    for key, items in by_key(data):
        fails, timer = 0, None
        for _, _, ms, _, value in items:
            if timer is not None and timer < ms:
                if fails >= 2:
                    out.append((key, timer, fails))
                fails, timer = 0, None
            if value >= 3:
                fails += 1
                timer = timer if timer is not None else ms + TIMEOUT
            elif value == 0:
                fails, timer = 0, None
        if timer is not None and fails >= 2:
            out.append((key, timer, fails))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_pair_sums(spark, seed, tiny_slices):
    data = random_rows(seed)
    df = frame(spark, data)
    left, right = df.where("src = 'left'"), df.where("src = 'right'")
    got = machines.pair_sum(left, right, ["k"], ["o"], "ts", "value", TIMEOUT)
    assert rows(got, "k", "at_ms", "kind", "total") == simulate_pairs(data, clears=True, adds=False)
    got = pairs.pair_sum_accumulate(left, right, ["k"], ["o"], "ts", "value", TIMEOUT)
    assert rows(got, "k", "at_ms", "kind", "total") == simulate_pairs(data, clears=False, adds=True)


@pytest.mark.parametrize("seed", range(3))
def test_timers(spark, seed, tiny_slices):
    data = random_rows(seed + 10)
    df = frame(spark, data)
    assert rows(machines.rising_alert(df, ["k"], ["o"], "ts", "value", TIMEOUT), "k", "at_ms", "value") == simulate_rising(data)
    got = machines.fail_burst(df, ["k"], ["o"], "ts", F.col("value") >= 3, F.col("value") == 0, TIMEOUT)
    assert rows(got, "k", "at_ms", "fails") == simulate_fails(data)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("limit", ["1", "20", "1000"])
def test_scans_equal_plain_windows(spark, keys, limit):
    df = frame(spark, random_rows(99)).withColumn("value", F.when(F.col("o") % 7 != 0, F.col("value")))
    w = Window.partitionBy(*keys or [F.lit(0)]).orderBy("ms", "o")
    upto, before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    is_left = F.col("src") == "left"
    want = df.select(
        "o", F.sum("value").over(upto), F.count("*").over(before), F.max("value").over(before), F.min("value").over(upto), F.lag("value").over(w),
        F.lead("value").over(w), F.lead("value", 2).over(w), F.last(F.when(is_left, F.col("o")), True).over(upto),
        F.first(F.when(is_left, F.col("o")), True).over(after), F.collect_list("o").over(upto),
    )
    spark.conf.set("spark.brooklet.rowsPerSlice", limit)
    try:
        got = Ordered(df, keys, ["ms", "o"]).scan(
            a=Sum("value"), b=Count(inclusive=False), c=Max("value", inclusive=False), d=Min("value"), e=Last("value"), f=Next("value"),
            h=Last("o", where=is_left, inclusive=True), i=Next("o", where=is_left), j=History("o"),
        ).scan(g=Next("f"))
        assert rows(got.result("o", "a", "b", "c", "d", "e", "f", "g", "h", "i", "j")) == rows(want)
    finally:
        spark.conf.unset("spark.brooklet.rowsPerSlice")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how, tiny_slices):
    data = frame(spark, random_rows(5)).withColumn("k", F.when(F.col("o") % 11 != 0, F.col("k")))
    left = data.where("src = 'left'").select("k", F.col("o").alias("a"))
    right = data.where("src = 'right' AND k <> 2").select("k", F.col("o").alias("b"))
    assert rows(joins.salted_join(left, right, ["k"], how), "k", "a", "b") == rows(left.join(right, ["k"], how), "k", "a", "b")
