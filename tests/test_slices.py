"""Hot keys: equal slices, one read of the input, one probe."""

import re

import pytest
from pyspark.sql import functions as F

from brooklet.operators import ordered
from brooklet.operators.ordered import ROWS_PER_SLICE_CONF, Count, Last, Ordered, Sum
from brooklet.operators.stateful import history_elements, history_list
from brooklet.plans import QUERIES
from tests.conftest import DATA, rows


@pytest.fixture
def limit_1000(spark):
    spark.conf.set(ROWS_PER_SLICE_CONF, "1000")
    yield
    spark.conf.unset(ROWS_PER_SLICE_CONF)


def positions(kind):
    one = F.col("id")
    return {
        "outlier": F.when(one == 0, 0).otherwise(1_700_000_000_000 + one).cast("double"),
        "fraction": one / 10_000_000,
        "burst": F.when(one % 10 == 0, one * 1_000_000).otherwise(5_000_000_000 + one).cast("double"),
    }[kind]


@pytest.mark.parametrize("kind", ["outlier", "fraction", "burst"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_slices_have_equal_rows(spark, limit_1000, kind, keys):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), positions(kind).alias("p"), F.col("id"))
    line = Ordered(df, keys, ["p", "id"])
    sizes = [r["count"] for r in line.df.groupBy("__slice").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 2_000
    got = line.scan(n=Count(), total=Sum("id"), before=Last("id")).result().orderBy("p", "id").collect()
    assert [r.n for r in got] == list(range(1, 20_001))
    assert all(b.before == a.id and b.total == a.total + b.id for a, b in zip(got, got[1:]))


def test_rows_at_one_position_stay_together_and_count_once(spark, limit_1000):
    df = spark.range(6_000).select(F.lit("hot").alias("k"), F.floor(F.col("id") / 3_000).alias("p"), F.col("id"))
    got = Ordered(df, ["k"], ["p", "id"]).scan(n=Count()).result()
    assert rows(got.select((F.col("n") - F.col("id")).alias("d")).distinct()) == [(1,)]


def test_short_sequences_are_cut_as_well(spark):
    df = spark.range(5_000).withColumnRenamed("id", "o")
    assert Ordered(df, [], ["o"]).df.select("__slice").distinct().count() >= spark.sparkContext.defaultParallelism


def reads(spark, name):
    df = QUERIES[name](spark, DATA)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet \[(?!__k)", text))


@pytest.mark.parametrize("name", ["agg_running_sum", "win_over_rows", "cep_generic", "cep_triple_hot", "pair_sum_sticky", "agg_chain_reduce_maxby", "st_ip_change"])
def test_hot_keys_read_the_input_once(spark, tiny_slices, name):
    sliced = reads(spark, name)
    spark.conf.unset(ROWS_PER_SLICE_CONF)
    assert sliced == reads(spark, name)


def test_inputs_are_probed_once(spark, monkeypatch):
    asked = []
    real = ordered.probe_keys
    monkeypatch.setattr(ordered, "probe_keys", lambda *a: asked.append(a) or real(*a))
    df = spark.range(100).select(F.lit(1).alias("only_here"), F.col("id").alias("o"))
    for _ in range(3):
        Ordered(df, ["only_here"], ["o"])
    assert len(asked) == 1


def test_long_and_list_form_of_histories_agree(spark, limit_1000):
    df = spark.range(2_500).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), (F.col("id") * 7 % 11).alias("v"))
    long = history_elements(df, ["k"], ["o"]).collect()
    values = {}
    for r in sorted(long, key=lambda r: r.position):
        values.setdefault(r.k, []).append(r.v)
    for r in history_list(df, ["k"], ["o"], "v").where("o % 500 < 2").collect():
        assert r.history == values[r.k][: r.o // 2 + 1]
