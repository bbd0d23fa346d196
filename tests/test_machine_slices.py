"""Machines on one key that never pauses: slices are composed, and the result is that of a plain simulation."""

import random

import pytest
from pyspark.sql import functions as F

from brooklet.operators import machines
from brooklet.operators.ordered import ROWS_PER_SLICE_CONF
from tests.conftest import rows
from tests.test_brute_force import TIMEOUT, frame, simulate_fails, simulate_pairs, simulate_rising


@pytest.fixture
def small_slices(spark):
    spark.conf.set(ROWS_PER_SLICE_CONF, "25")
    yield 25
    spark.conf.unset(ROWS_PER_SLICE_CONF)


@pytest.fixture
def tiny(spark):
    """Slices shorter than the timers."""
    spark.conf.set(ROWS_PER_SLICE_CONF, "4")
    yield
    spark.conf.unset(ROWS_PER_SLICE_CONF)


def restless(kind, n=600):
    """(o, k, ms, src, value) of one key without a silence as long as the timers; a few rows of another one."""
    rnd, ms, out = random.Random(kind), 0, []
    for o in range(n):
        ms += {"even": 1, "alternating": 3}.get(kind) or rnd.choice([0, 1, 1, 2, 4, 9])
        src = ("left", "right")[o % 2] if kind in ("even", "alternating") else rnd.choice(["left", "right", "right"])
        value = {"even": float(o), "alternating": float(3 + o % 3)}.get(kind, float(rnd.randrange(6)))
        out.append((o, 0, ms, src, value))
    return out + [(n + i, 1, 5 * i, "left", 1.0) for i in range(5)]


KINDS = ["even", "alternating", "random", "other random"]


@pytest.mark.parametrize("kind", KINDS)
def test_pair_sums(spark, small_slices, kind):
    data = restless(kind)
    df = frame(spark, data)
    got = machines.pair_sum(df.where("src = 'left'"), df.where("src = 'right'"), ["k"], ["o"], "ts", "value", TIMEOUT)
    assert rows(got, "k", "at_ms", "kind", "total") == simulate_pairs(data, clears=True, adds=False)


@pytest.mark.parametrize("kind", KINDS)
def test_rising_alerts(spark, small_slices, kind):
    # Never a fall: nothing clears the state.
    data = [(o, k, ms, src, float(o // 3)) for o, k, ms, src, _ in restless(kind)]
    got = machines.rising_alert(frame(spark, data), ["k"], ["o"], "ts", "value", TIMEOUT)
    assert rows(got, "k", "at_ms", "value") == simulate_rising(data) != []


@pytest.mark.parametrize("kind", KINDS)
def test_fail_bursts(spark, small_slices, kind):
    # Never a success.
    data = [(o, k, ms, src, 1.0 + value) for o, k, ms, src, value in restless(kind)]
    got = machines.fail_burst(frame(spark, data), ["k"], ["o"], "ts", F.col("value") >= 3, F.col("value") == 0, TIMEOUT)
    assert rows(got, "k", "at_ms", "fails") == simulate_fails(data) != []


def test_slices_shorter_than_the_timers(spark, tiny):
    data = restless("random", 150)
    df = frame(spark, data)
    got = machines.pair_sum(df.where("src = 'left'"), df.where("src = 'right'"), ["k"], ["o"], "ts", "value", TIMEOUT)
    assert rows(got, "k", "at_ms", "kind", "total") == simulate_pairs(data, clears=True, adds=False)
    data = [(o, k, ms, src, float(o // 3)) for o, k, ms, src, _ in data]
    assert rows(machines.rising_alert(frame(spark, data), ["k"], ["o"], "ts", "value", TIMEOUT), "k", "at_ms", "value") == simulate_rising(data)


def test_no_task_runs_the_whole_key(spark, small_slices, monkeypatch):
    df = frame(spark, restless("random"))
    entries = []
    real = machines._entries
    monkeypatch.setattr(machines, "_entries", lambda *a: entries.append(real(*a)) or entries[-1])
    machines.pair_sum(df.where("src = 'left'"), df.where("src = 'right'"), ["k"], ["o"], "ts", "value", TIMEOUT).collect()
    states = entries[0].collect()
    assert len(states) >= 600 / small_slices / 2 and all(r.entry for r in states)
    assert sum(r.last for r in states) == 1


def test_summaries_tell_every_entry_state():
    """The step function of a slice against a run from each state it can be entered in."""
    rnd = random.Random(4)
    for machine in (machines.RisingAlert(10), machines.FailBurst(10, 2)):
        for _ in range(200):
            ms, at = [], 100
            for _ in range(rnd.randrange(1, 25)):
                at += rnd.choice([0, 1, 2, 5, 9])
                ms.append(at)
            values = [[float(i) for i in range(len(ms))], [float(i) - rnd.choice([0, 1]) for i in range(len(ms))]] if isinstance(machine, machines.RisingAlert) else [[True] * len(ms)]
            summary = machine.summary(False, [])
            summary.add(ms, values, False)
            told = summary.done()
            for timer in [None, *range(95, 112)]:
                state = {**machine.start(), "timer": timer}
                if "fails" in state and timer is not None:
                    state["fails"] = 3
                run = dict(state)
                for t, *v in zip(ms, *values):
                    machine.advance(run, t, machine.timer_first)
                    machine.row(run, t, *v)
                assert machine.through([told], state) == run
