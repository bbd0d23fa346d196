"""Every registered query against its SQL, at the default slice size and with every key cut into tiny slices."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from brooklet.operators.ordered import ROWS_PER_SLICE_CONF
from tests.conftest import DATA

from brooklet.plans import ORACLES, QUERIES  # noqa: E402

# Queries that scan keys in order, i.e. those whose plan changes when a key is hot.
SCANNING = [
    q for q in QUERIES
    if q.startswith(("agg_running", "agg_chain", "agg_distinct", "win_", "late_", "wm_", "pair_", "bcast_", "st_", "cep_", "join_window", "fn_reduce", "fn_join", "order_"))
    and q != "st_recovery"
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted("|".join(plain(r[i]) for i in order) for r in records)


def compare(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    want = table([c[0] for c in result.description], result.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", SCANNING)
def test_query_with_hot_keys(spark, duck, name):
    spark.conf.set(ROWS_PER_SLICE_CONF, "25")
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.unset(ROWS_PER_SLICE_CONF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
