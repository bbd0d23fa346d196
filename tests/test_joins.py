"""Joins with hot keys on both sides, and user functions over joins."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brooklet.operators import joins, ordered
from brooklet.operators.ordered import ROWS_PER_SLICE_CONF, Ordered, Sum
from brooklet.session import discard_saved, saved, saved_paths, shared_folder
from tests.conftest import rows


@pytest.fixture
def limit_50(spark):
    spark.conf.set(ROWS_PER_SLICE_CONF, "50")
    yield
    spark.conf.unset(ROWS_PER_SLICE_CONF)


def sides(spark, n=1_000):
    """Half of both sides under one key; a key hot on each side alone, with and without a partner; null keys."""
    rnd = random.Random(3)
    keys = lambda hot: [0 if i % 2 else rnd.choice([*[hot] * 10, *[None] * 5, *range(5, 30)]) for i in range(n)]
    left = [(k, i, i % 3) for i, k in enumerate(keys(1))] + [(3, n, 0)]
    right = [(k, i) for i, k in enumerate(keys(2))] + [(1, n), (2, n + 1)]
    return spark.createDataFrame(left, "k int, a int, c int"), spark.createDataFrame(right, "k int, b int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_on_both_sides(spark, limit_50, how):
    left, right = sides(spark)
    assert rows(joins.salted_join(left, right, ["k"], how), "k", "a", "b") == rows(left.join(right, ["k"], how), "k", "a", "b")


def test_cells_are_small(spark, limit_50):
    left, right = sides(spark)
    hot, _ = joins._hot_keys(left, right, ["k"], 50)
    grid = {r[0]: (r[1], r[2]) for r in hot.collect()}
    assert grid[0][0] >= 4 and grid[0][1] >= 4 and None not in grid and 1 in grid and 2 in grid
    parts = left.where("k = 0").select(F.pmod(F.xxhash64("k", "a", "c"), F.lit(grid[0][0])).alias("i")).groupBy("i").count()
    assert parts.agg(F.max("count")).first()[0] <= 100


def test_the_sketch_is_taken_once(spark, limit_50, monkeypatch):
    left, right = sides(spark)
    joins.salted_join(left, right, ["k"])
    before = len(joins._HOT_KEYS)
    joins.salted_join(left, right, ["k"], "left")
    assert len(joins._HOT_KEYS) == before


def test_user_functions(spark):
    left = spark.createDataFrame([(1, 10, 0), (1, 11, 5), (2, 12, 0)], "k int, a int, s long").withColumn("l_ts", F.timestamp_seconds("s")).drop("s")
    right = spark.createDataFrame([(1, 20, 1), (3, 21, 0)], "k int, b int, s long").withColumn("r_ts", F.timestamp_seconds("s")).drop("s")
    pairs = joins.window_join(left, right, ["k"], "l_ts", "r_ts", 4_000)
    made = joins.join_with(pairs.select("a", "b"), lambda p: pd.DataFrame({"sum": p["a"] + p["b"]}), "sum long")
    assert rows(made) == [(30,)]

    def sizes(l, r):
        one = l if len(l) else r
        return pd.DataFrame({"k": [int(one["k"].iloc[0])], "l": [len(l)], "r": [len(r)]})

    grouped = joins.window_cogroup(left, right, ["k"], "l_ts", "r_ts", 4_000, sizes, "k int, l int, r int")
    assert rows(grouped) == [(1, 1, 0), (1, 1, 1), (2, 1, 0), (3, 0, 1)]


def test_user_functions_of_columns(spark):
    left = spark.createDataFrame([(1, 10, 0), (1, 11, 5), (2, 12, 0)], "k int, a int, s long").withColumn("l_ts", F.timestamp_seconds("s")).drop("s")
    right = spark.createDataFrame([(1, 20, 1), (1, 19, 2), (3, 21, 0)], "k int, b int, s long").withColumn("r_ts", F.timestamp_seconds("s")).drop("s")
    made = joins.join_function(left, right, ["k"], "l_ts", "r_ts", 4_000, lambda l, r: [(l("a") + r("b")).alias("sum")])
    assert rows(made) == [(29,), (30,)]

    def listed(l, r):
        return F.array(F.struct(F.size(l).alias("l"), F.array_join(F.transform(r, lambda x: x["b"].cast("string")), ",").alias("r")))

    grouped = joins.cogroup_function(left, right, ["k"], "l_ts", "r_ts", 4_000, listed, ("a", "b"))
    assert rows(grouped) == [(0, "21"), (1, ""), (1, ""), (1, "19,20")]


def test_cleaning_leaves_nothing_behind_and_breaks_nothing(spark, limit_50):
    df = saved(spark.range(500).select((F.col("id") % 2).alias("k"), "id"), "test-input")
    kept = saved_paths()[-1]
    line = lambda: rows(Ordered(df, ["k"], ["id"]).scan(t=Sum("id")).result())
    first = line()
    left, right = sides(spark)
    joined = rows(joins.salted_join(left, right, ["k"]))
    discard_saved(spark, [p for p in saved_paths() if p != kept])
    assert line() == first and rows(joins.salted_join(left, right, ["k"])) == joined
    assert not ordered._PROBES or all(p in saved_paths() for p in saved_paths())
    discard_saved(spark)
    assert saved_paths() == []
    store = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    left_over = store.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(store)
    assert [f.getPath().getName() for f in left_over if "test-input" in f.getPath().getName()] == []


def test_more_slices_than_one_pass_takes(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MOST_CUTS", 20)
    spark.conf.set(ROWS_PER_SLICE_CONF, "10")
    try:
        for keys in (["k"], []):
            df = spark.range(6_000).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.lit(len(keys)).alias("x"))
            line = Ordered(df, keys, ["o"])
            sizes = [r["count"] for r in line.df.groupBy("__slice").count().collect()]
            assert len(sizes) > 200 and max(sizes) <= 60
            got = line.scan(t=Sum("x")).result().orderBy("o").collect()
            assert [r.t for r in got] == [len(keys) * (i + 1) for i in range(6_000)]
    finally:
        spark.conf.unset(ROWS_PER_SLICE_CONF)


def test_places_are_found_by_halving(spark):
    bounds = [1.0, 2.5, 2.5, 7.0]
    df = spark.createDataFrame([(float(v),) for v in range(-1, 9)] + [(2.5,), (None,)], "v double").withColumn("b", ordered._doubles(bounds))
    placed = ordered.place_in(df, "b", F.col("v"), len(bounds), "at")
    assert all(r.at == sum(x < r.v for x in bounds) if r.v is not None else r.at == 0 for r in placed.collect())
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
