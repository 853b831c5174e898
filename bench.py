"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's whole result is computed and thrown away (``noop`` sink): one warm-up, then
the median of $BENCH_RUNS runs (of one run where the warm-up took over five seconds). Queries that write tables write new ones in every run.
Landing zones are the input of the feeder and scan queries and are written before the clock
starts, as a loader would have left them; ``setup`` says how long that took.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.catalogue import QUERIES
from millrace.catalogue import inputs as i
from millrace.catalogue.incremental import events_landing
from millrace.session import local_session

HEADLINE = [
    "fct_sales", "model_orders", "model_order_refunds", "model_customers", "model_profiles", "model_events",
    "model_campaigns", "model_erp_orders", "model_erp_order_lines", "model_order_tags", "model_wholesale_lines",
    "dedupe_latest", "dedupe_by_load_id", "dedupe_then_agg", "left_join_refunds", "inner_join_validity",
    "anti_join_orphans", "agg_refunds", "daily_totals", "incremental_or_filter", "flatten_order_items",
    "json_nested_path", "explode_tags", "natural_sort", "sort_fact", "scan_file_list", "scan_partition_range",
    "files_after_cursor", "semantic_query", "semantic_time_grain", "infer_schema", "upsert_single_key",
    "upsert_composite_key", "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    start = time.perf_counter()
    i.table(spark, sf_dir, "orders").count()
    events_landing(spark, sf_dir)
    setup = time.perf_counter() - start
    seconds = {}
    for name in names:
        repeats = 1 if run(name) > 5 else runs
        seconds[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    line = {
        "metric": "headline queries, total of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup": round(setup, 3),
        "cores": cores,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
