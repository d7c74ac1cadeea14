"""Shapes that plans must keep: no all-pairs joins, no one-task windows, narrow scans."""

import re

import pytest

from logtide.plans import QUERIES

WATCHED = [
    "assign_offsets", "alert_states", "click_session_join", "counter_increase", "delivery_gaps", "hot_keys",
    "idempotent_outcomes", "interval_join_1h", "key_order_check", "read_committed", "reconcile_systems", "salt_sweep",
    "saga_terminal", "trace_tree",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WATCHED)
def test_no_all_pairs_join_and_no_one_task_window(spark, sf, name):
    plan = plan_of(QUERIES[name].plan(spark, sf))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    for window in re.findall(r"Window \[.*\], \[(.*?)\], \[", plan):
        assert window, "a window without partition keys"
    # Windows over a log are partitioned by more than the topic and its partition.
    for keys in re.findall(r"Window \[lag.*?\], \[(topic#\d+, partition#\d+)\], \[offset", plan):
        pytest.fail(f"window over a whole topic partition: {keys}")


@pytest.mark.parametrize("name, columns", [
    ("revenue_by_category", {"event_id", "event_type", "value"}),
    ("event_type_share", {"event_type"}),
    ("hot_keys", {"event_id", "user_id"}),
    ("status_totals", {"o_orderkey", "o_totalprice"}),
])
def test_scans_read_only_what_is_used(spark, sf, name, columns):
    plan = plan_of(QUERIES[name].plan(spark, sf))
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan):
        assert {c.split(":")[0] for c in schema.split(",")} <= columns


def test_hot_path_stays_out_of_python(spark, sf):
    for name in ("payments_per_minute", "raw_to_typed_orders", "latest_by_offset", "retry_attempts", "counter_rate"):
        assert "Python" not in plan_of(QUERIES[name].plan(spark, sf)), name


def test_a_stored_log_is_one_scan_with_pushed_offsets(spark, sf):
    log = QUERIES["log_scan"].plan(spark, sf)
    plan = plan_of(log)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    narrowed = plan_of(log.filter("offset = 5"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(offset,5\)", narrowed)


@pytest.mark.parametrize("name", ["delivery_audit", "reconcile_systems"])
def test_audits_join_nothing(spark, sf, name):
    assert "Join" not in plan_of(QUERIES[name].plan(spark, sf))
