"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3 by default) into a no-op sink; the median
counts. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from brooklet.plans import QUERIES
from brooklet.session import build_session

HEADLINE = [
    "win_tumble_table", "win_tumble_sum", "win_count_sliding", "win_over_rows", "win_state_cumulative", "win_late_side_output",
    "win_allowed_lateness", "wm_bounded", "agg_word_count", "agg_running_sum", "agg_running_max_by", "agg_distinct_running", "agg_top2_keyed",
    "join_window_inner", "join_window_left_all", "join_lookup", "order_enrich", "pair_sum_timeout", "pair_sum_accumulate", "bcast_blacklist",
    "bcast_keyed_rules", "st_ip_change", "st_inactivity_timeout", "st_rising_alert", "st_login_fail_timer", "st_delimited_segments",
    "cep_consecutive_fail", "cep_triple_hot", "cep_order_timeout", "cep_generic", "fn_java_hash", "json_explode_cdc", "src_wide_column_scan",
    "sink_document_upsert", "udtaf",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app="brooklet-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
