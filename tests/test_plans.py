"""What the physical plans must look like."""

import re

import pytest

from tests.conftest import DATA

from brooklet.plans import QUERIES  # noqa: E402

PYTHON = {"udf_scalar_inline", "udf_scalar_registered", "udtf_inline", "udtf_registered", "udaf_registered", "udtaf", "fn_rich",
          "st_rising_alert", "st_login_fail_timer", "pair_sum_timeout", "fn_java_hash", "sink_key_partition"}
WRITES_FILES = {"src_dir_monitor", "src_socket_lines", "sink_exactly_once", "st_recovery", "src_text", "src_paced_file_replay", "src_csv_table",
                "sink_row_file", "sink_csv_table", "sink_log_append"}


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FILES))
def test_no_nested_loops_and_no_stray_python(spark, name):
    text = plan(spark, name)
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    if name not in PYTHON:
        assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|PythonUDTF", text)


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize(
    "name, count",
    [("agg_running_sum", 1), ("agg_chain_reduce_maxby", 1), ("win_over_rows", 1), ("cep_triple_hot", 1), ("cep_generic", 1), ("st_inactivity_timeout", 1),
     ("win_tumble_table", 1), ("agg_final_max_by", 1), ("win_state_cumulative", 2)],
)
def test_shuffles_once_per_key(spark, name, count):
    assert exchanges(plan(spark, name)) == count


def test_hot_keys_shuffle_by_slice(spark, tiny_slices):
    text = plan(spark, "agg_running_sum")
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+L, __hot#\d+, __slice#\d+L", text)


def test_scans_read_only_what_they_need(spark):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan(spark, "agg_running_sum")
    text = plan(spark, "cep_triple_hot")
    assert "GreaterThanOrEqual(value,60.0)" in text and "props" not in text.split("ReadSchema:")[1]
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan(spark, "table_select_filter")


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "agg_top2")
    assert "WindowGroupLimit" in plan(spark, "agg_top2_keyed")
