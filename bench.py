"""Times the headline queries and prints one JSON line.

Each query runs whole into a no-op sink, once to warm up and then timed. Stored logs are built first and timed as ``build_log_orders`` and
``build_log_payments``: queries then scan them as they would scan a topic.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from logtide.plans import QUERIES, derived
from logtide.session import build_session

HEADLINE = [
    "revenue_by_category", "event_type_share", "top_products", "daily_trend", "status_totals", "log_scan",
    "json_stream_orders", "raw_to_typed_orders", "raw_to_typed_payments", "safe_parse_split", "shape_guard",
    "partition_assign", "partition_distribution", "salt_sweep", "salted_sum", "hot_keys", "assign_offsets",
    "key_order_check", "interval_join_1h", "click_session_join", "payments_per_minute", "latest_by_offset",
    "pipe_payments", "retry_attempts", "saga_terminal", "saga_audit", "dlq_records", "idempotent_outcomes",
    "batched_idempotent", "delivery_audit", "read_committed", "reconcile_systems", "stage_latency", "consumer_lag",
    "counter_rate", "counter_increase", "alert_states", "trace_tree", "claim_check_verify", "clustered_table",
    "continuous_ingest", "codec_footprint",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("logtide-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="logtide-bench-"),
        "spark.ui.showConsoleProgress": "false", "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name].plan(spark, folder).write.format("noop").mode("overwrite").save()

    run("partition_assign")  # starts the Python workers
    seconds = {
        "build_log_orders": timed(lambda: derived.log_orders(spark, folder)),
        "build_log_payments": timed(lambda: derived.log_payments(spark, folder)),
    }
    for name in names:
        run(name)
        seconds[name] = timed(lambda: run(name))
    seconds = {k: round(v, 3) for k, v in seconds.items()}
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
