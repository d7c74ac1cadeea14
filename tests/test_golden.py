"""Small recorded experiments with known results, one test per behaviour."""

import datetime as dt
import hashlib
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from logtide import schemas as S
from logtide.functions import rules as R
from logtide.functions.jsontext import is_json
from logtide.functions.tracecontext import carried, inject, parent_of
from logtide.operators import claims, decode, delivery as V, gate, observe, partitions, retry, stages, traces
from logtide.operators.joins import interval_join
from logtide.sinks.log import kafka_rows, place, to_log
from logtide.sinks.tables import (
    gated_append, read_evolved, read_quarantine, read_sink_lines, write_clustered, write_sorted_out, write_with_quarantine,
)
from logtide.sources.files import read_blobs, read_lines
from logtide.sources.incremental import incremental_read, jdbc_incremental_options, next_mark
from logtide.sources.log import from_kafka, kafka_options

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 1, 1, tzinfo=UTC)

SEED = [
    ("order-1", "cust-A", "sku-100", 2, 39.98, "created"), ("order-2", "cust-B", "sku-200", 1, 15.0, "created"),
    ("order-3", "cust-C", "sku-300", 3, 89.97, "created"), ("order-4", "cust-A", "sku-100", 1, 19.99, "created"),
    ("order-5", "cust-D", "sku-400", 5, 250.0, "created"), ("order-6", "cust-B", "sku-200", 2, 30.0, "created"),
    ("order-1", "cust-A", "sku-100", 2, 39.98, "updated"), ("order-2", "cust-B", "sku-200", 1, 15.0, "updated"),
]


@pytest.fixture(scope="module")
def seed_log(spark):
    data = [
        (k, json.dumps({"orderId": k, "customerId": c, "items": [{"sku": s, "qty": q}], "total": t, "status": st}),
         "orders", 0, i, T0 + dt.timedelta(seconds=i), {})
        for i, (k, c, s, q, t, st) in enumerate(SEED)
    ]
    return spark.createDataFrame(data, S.ENVELOPE)


def deliveries(log, offsets):
    return log.withColumn("delivery_seq", F.explode(F.array(F.lit(1), F.lit(2)))).filter(
        (F.col("delivery_seq") == 1) | F.col("offset").isin(offsets))


def test_idempotent_rerun(seed_log):
    tagged = V.delivery_outcomes(deliveries(seed_log, [2]))
    outcomes = rows(tagged, "offset", "delivery_seq", "outcome")
    assert [o for o in outcomes if o[2] == "duplicate"] == [(2, 2, "duplicate")]
    assert len([o for o in outcomes if o[2] == "applied"]) == 8
    status = F.get_json_object("value", "$.status")
    counts = V.effect_counts(tagged.filter("outcome = 'applied'").withColumn("status", status), "key", "status",
                             "timestamp", ["partition", "offset"])
    assert rows(counts, "key", "effect_count", "status") == [
        (f"order-{i}", 2 if i < 3 else 1, "created") for i in range(1, 7)]


def test_ledger_makes_a_rerun_all_duplicates(seed_log):
    again = V.delivery_outcomes(seed_log.withColumn("delivery_seq", F.lit(1)), ledger=seed_log)
    assert {r.outcome for r in again.select("outcome").distinct().collect()} == {"duplicate"}


def test_at_most_once_loses_offset_2(seed_log):
    log = seed_log.select(*V.DELIVERY)
    audit = V.delivery_audit(log, log.filter("offset <> 2"))
    assert rows(audit.filter("verdict = 'lost'"), "offset") == [(2,)]
    assert V.delivery_verdict(audit).first().guarantee == "at-most-once"


def test_at_least_once_repeats_offset_2(seed_log):
    log = seed_log.select(*V.DELIVERY)
    audit = V.delivery_audit(log, deliveries(log, [2]))
    verdict = V.delivery_verdict(audit).first()
    assert (verdict.logged, verdict.effects, verdict.duplicated, verdict.guarantee) == (8, 9, 1, "at-least-once")


def test_business_duplicates_are_reported_not_dropped(spark):
    log = spark.createDataFrame(
        [("order-1", "x", "orders", 0, 0), ("order-1", "x", "orders", 0, 1), ("order-1", "y", "orders", 0, 2)],
        "key string, value string, topic string, partition int, offset bigint")
    assert rows(V.business_duplicates(log), "key", "copies", "first_offset", "last_offset") == [("order-1", 2, 0, 1)]


def test_poison_is_set_aside(spark, seed_log, tmp_path):
    poison = spark.createDataFrame([(None, "heyyy", "orders", 0, 8, T0, {}), (None, None, "orders", 0, 9, T0, {})], S.ENVELOPE)
    good, bad = decode.parse_split(seed_log.unionByName(poison))
    assert good.count() == 8
    assert rows(bad, "offset", "reject_reason") == [(8, "invalid_json"), (9, "null_value")]
    write_with_quarantine(seed_log.unionByName(poison), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert read_lines(spark, str(tmp_path / "good")).count() == 8
    assert rows(spark.read.parquet(str(tmp_path / "bad")), "value") == [("heyyy",), (None,)]


VALID = ['{"a":1}', ' [1, 2] ', '"s"', "1", "-0.5e3", "true", '{"a":{"b":[null]}}', '"end-of-value/7d1f"', '{"v":2,"w":1}']
INVALID = ["heyyy", "", "1 2", "{} x", '1,"v":2', "[1],[2", "1}{", "{'a':1}", "{},0],[", '{"a":1', "NaN", "01", '"a',
           '1,"end-of-value/7d1f"],[2', '{},"end-of-value/7d1f"],["x"', '{}\n{}']


def test_one_json_value_and_nothing_else(spark):
    df = spark.createDataFrame([(v,) for v in VALID + INVALID], "v string")
    got = {r.v: r.ok for r in df.select("v", is_json(F.col("v")).alias("ok")).collect()}
    assert got == {**{v: True for v in VALID}, **{v: False for v in INVALID}}


def test_unwrap_takes_both_encodings(spark):
    inner = '{"type":"OrderCreated","order":{"orderId":"o-1","customerId":"c","total":3,"status":"created"}}'
    values = [json.dumps(inner), inner, "heyyy", json.dumps("not json"), json.dumps(json.dumps(3))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    assert rows(decode.unwrap_log(df), "i", "document") == [(0, inner), (1, inner), (2, None), (3, None), (4, "3")]
    typed = decode.raw_to_typed(df.select(F.col("value").alias("raw")), decode.ORDER_PATHS, "order_id")
    assert rows(typed) == [("o-1", "c", 3.0, "created")]


def test_shape_guard_tells_number_from_text(spark):
    base = {"eventId": "e", "bucket": "b", "key": "k", "sizeBytes": 3, "checksum": "c", "contentType": "t"}
    values = [json.dumps(base), json.dumps({**base, "sizeBytes": "3"}), '{"eventType":"page_view"}', "[]", "heyyy",
              json.dumps({**base, "sizeBytes": 2.5, "extra": None})]
    shape = {n: "number" if n == "sizeBytes" else "string" for n in base}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    assert rows(decode.shape_guard(df, shape), "i", "shape_ok") == [
        (0, True), (1, False), (2, False), (3, False), (4, False), (5, True)]


def test_error_budget_fails_the_block_not_silently(spark):
    df = spark.range(300).select("id", (F.col("id") % 100 < 3).alias("bad"))
    good, bad = decode.error_budget(df, F.col("bad"), F.floor(F.col("id") / 100), max_bad=3)
    assert (good.count(), bad.count()) == (291, 9)
    with pytest.raises(decode.ErrorBudgetExceeded, match="3 broken records, budget 2"):
        decode.error_budget(df, F.col("bad"), F.floor(F.col("id") / 100), max_bad=2)


def test_wire_header(spark):
    frames = [b"\x00\x00\x00\x00\x2apayload", b"\x01\x00\x00\x00\x2apayload", b"\x00\x00", b"\x00\xff\xff\xff\xff"]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(frames)], "i int, body binary")
    got = [(r.i, r.schema_id, None if r.payload is None else bytes(r.payload)) for r in decode.wire_header(df).orderBy("i").collect()]
    assert got == [(0, 42, b"payload"), (1, None, None), (2, None, None), (3, 4294967295, b"")]


def test_schema_versions_read_together(spark):
    log = spark.createDataFrame([
        (1, '{"orderId":"order-1","customerId":"c","items":[],"total":1.5,"status":"created"}'),
        (2, '{"orderId":"order-2","customerId":"c","items":[],"total":2.5,"status":"created","discountCode":"SUMMER10"}'),
        (2, '{"orderId":"order-3","customerId":"c","items":[],"total":3.5,"status":"created","discountCode":null}'),
    ], "schema_id int, value string")
    got = decode.read_versions(log, {1: S.ORDER_V1, 2: S.ORDER_V2})
    assert rows(got, "orderId", "discountCode") == [("order-1", None), ("order-2", "SUMMER10"), ("order-3", None)]


def test_schema_gate_rule():
    assert gate.require_compatible(S.ORDER_V1, S.ORDER_V2).added == ["discountCode"]
    assert gate.compare(S.ORDER_V2, S.ORDER_V1).removed == ["discountCode"]
    with pytest.raises(gate.IncompatibleSchema, match="shippingAddress"):
        gate.require_compatible(S.ORDER_V2, S.ORDER_V3)
    narrower = T.StructType([T.StructField("orderId", T.IntegerType())])
    assert not gate.compare(S.ORDER_V1, narrower).compatible


def test_gated_append_evolves_and_refuses(spark, tmp_path):
    path = str(tmp_path / "orders")
    v1 = spark.createDataFrame([("order-1", 1.0)], "orderId string, total double")
    v1.write.parquet(path)
    gated_append(spark.createDataFrame([("order-2", 2.0, "SUMMER10")], "orderId string, total double, discountCode string"), path)
    assert rows(read_evolved(spark, path), "orderId", "discountCode") == [("order-1", None), ("order-2", "SUMMER10")]
    with pytest.raises(gate.IncompatibleSchema, match="total"):
        gated_append(spark.createDataFrame([("order-3", "x")], "orderId string, total string"), path)
    assert read_evolved(spark, path).count() == 2


def test_bad_row_is_skipped_and_named(spark):
    df = spark.createDataFrame([("1", "2.5"), ("2", "x"), (None, "1.0"), ("4", None)], "a string, b string")
    schema = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.DoubleType(), True)])
    good, bad = gate.gate_rows(df, {"a": F.col("a"), "b": F.col("b")}, schema)
    assert rows(good) == [(1, 2.5), (4, None)]
    assert rows(bad, "misfit") == [("a",), ("b",)]


def test_incremental_polls(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "id int, item_name string")
    first = incremental_read(items, "id", None)
    assert rows(first, "id") == [(1,), (2,)]
    mark = next_mark(first, "id", None)
    more = items.unionByName(spark.createDataFrame([(3, "c")], items.schema))
    assert rows(incremental_read(more, "id", mark), "id") == [(3,)]
    assert next_mark(incremental_read(items, "id", mark), "id", mark) == mark
    opts = jdbc_incremental_options("jdbc:x", "t", "id", mark, 9, 4)
    assert opts["dbtable"] == "(SELECT * FROM t WHERE id > 2 AND id <= 9) polled"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("2", "9", "4")


def test_incremental_predicate_reaches_the_scan(spark, sf):
    plan = incremental_read(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey"), "o_orderkey", 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in text and "ReadSchema: struct<o_orderkey:bigint>" in text


def ms(n):
    return dt.datetime.fromtimestamp(n / 1000, UTC)


def test_interval_join_widens(spark):
    o = spark.createDataFrame([("order-1", ms(1785411444339))], "id string, ots timestamp")
    p = spark.createDataFrame([("order-1", ms(1785659551457))], "id string, pts timestamp")
    hour = 3_600_000
    assert interval_join(o, p, ["id"], "ots", "pts", hour, hour).count() == 0
    assert interval_join(o, p, ["id"], "ots", "pts", 120 * hour, 120 * hour).count() == 1


def test_interval_join_bounds_are_inclusive(spark):
    hour, base = 3_600_000, 1_785_411_444_339
    o = spark.createDataFrame([("k", ms(base))], "id string, ots timestamp")
    shifts = [-hour - 1, -hour, 0, hour, hour + 1]
    p = spark.createDataFrame([("k", ms(base + s), s) for s in shifts], "id string, pts timestamp, s bigint")
    assert rows(interval_join(o, p, ["id"], "ots", "pts", hour, hour), "s") == sorted([(-hour,), (0,), (hour,)], key=repr)
    assert rows(interval_join(o, p, ["id"], "ots", "pts", 0, hour), "s") == [(0,), (hour,)]


def test_interval_join_hot_key_against_brute_force(spark):
    left = [("hot" if i % 3 else f"k{i}", i * 700, i) for i in range(300)]
    right = [("hot" if i % 3 else f"k{i}", i * 650, i) for i in range(300)]
    l = spark.createDataFrame([(k, ms(t), i) for k, t, i in left], "id string, lts timestamp, li int")
    r = spark.createDataFrame([(k, ms(t), i) for k, t, i in right], "id string, rts timestamp, ri int")
    want = sorted(((i, j) for k, t, i in left for q, u, j in right if k == q and t - 2000 <= u <= t + 5000), key=repr)
    assert rows(interval_join(l, r, ["id"], "lts", "rts", 2000, 5000), "li", "ri") == want


def test_read_committed_hides_the_aborted_attempt(spark):
    data = [("order-1", 0, None), (None, 1, "COMMIT"), ("order-3", 20, None), (None, 21, "ABORT"),
            ("order-3", 22, None), (None, 23, "COMMIT"), ("order-4", 24, None)]
    log = spark.createDataFrame([("orders", 0, o, k, "tx", c) for k, o, c in data] + [("orders", 0, 25, "free", None, None)],
                                "topic string, partition int, offset bigint, key string, producer_id string, control string")
    assert rows(V.read_committed(log), "key", "offset") == [("free", 25), ("order-1", 0), ("order-3", 22)]
    assert [r[0] for r in rows(V.read_uncommitted(log), "key")].count("order-3") == 2


def test_latest_skips_nulls_per_column(spark):
    log = spark.createDataFrame([("o", 0, 0, "succeeded", 25.0), ("o", 0, 1, "refunded", None)],
                                "order_id string, partition int, offset bigint, status string, amount double")
    assert rows(V.latest_by_offset(log, "order_id", ["status", "amount"], ["partition", "offset"])) == [("o", "refunded", 25.0)]


RETRY_IDS = ["order-normal-1", "order-transient-fail-3", "order-permanent-fail-1", "order-transient-fail-5-9"]


def test_retry_plan(spark):
    plan = retry.retry_plan(spark.createDataFrame([(i,) for i in RETRY_IDS], "order_id string"), R.attempt_failure)
    last = plan.groupBy("order_id").agg(F.max("attempt"), F.max_by("outcome", "attempt"), F.max("waited_ms"))
    assert rows(last) == [
        ("order-normal-1", 1, "success", 0), ("order-permanent-fail-1", 3, "exhausted", 600),
        ("order-transient-fail-3", 3, "success", 600), ("order-transient-fail-5-9", 3, "exhausted", 600)]
    assert rows(plan.filter("order_id = 'order-transient-fail-3'"), "attempt", "outcome", "backoff_ms", "waited_ms") == [
        (1, "retry", 0, 0), (2, "retry", 200, 200), (3, "success", 400, 600)]
    assert rows(retry.message_outcomes(spark.createDataFrame([(i,) for i in RETRY_IDS], "order_id string")), "order_id", "attempts", "outcome") == [
        ("order-normal-1", 1, "success"), ("order-permanent-fail-1", 3, "exhausted"),
        ("order-transient-fail-3", 3, "retry"), ("order-transient-fail-5-9", 3, "exhausted")]


def test_dead_letter_has_full_context_once_per_delivery(spark):
    value = json.dumps({"orderId": "order-permanent-fail-1", "customerId": "c", "items": [{"sku": "s", "qty": 1}],
                        "total": 5.0, "status": "created"})
    log = spark.createDataFrame([(k, value, "orders", 2, i, T0, {}) for i, k in enumerate(RETRY_IDS[:3])], S.ENVELOPE)
    redelivered = log.withColumn("delivery_seq", F.explode(F.array(F.lit(1), F.lit(2))))
    once = V.distinct_deliveries(redelivered, "delivery_seq")
    records = retry.dead_letter_log(retry.dead_letters(once)).collect()
    assert [r.key for r in records] == ["order-permanent-fail-1"]
    body = json.loads(records[0].value)
    assert (body["originalTopic"], body["originalPartition"], body["originalOffset"]) == ("orders", 2, "2")
    assert body["order"]["items"] == [{"sku": "s", "qty": 1}]
    assert body["attempts"] == 3 and body["failureReason"].startswith("downstream rejected order-permanent-fail-1 (attempt 3)")
    assert body["failedAt"] == "2026-01-01T00:00:00.000Z"


def test_naive_dual_write_loses_an_event_and_the_outbox_does_not(spark):
    store = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    log = spark.createDataFrame([("o1",)], "order_id string")
    assert rows(V.lost_events(store, log, ["order_id"])) == [("o2",)]
    outbox = V.outbox_rows(store, "orders", "order_id", F.lit("OrderCreated"), F.lit("{}"))
    routed = V.relay(outbox)
    assert rows(routed, "topic", "key") == [("orders", "o1"), ("orders", "o2")]
    assert V.lost_events(store, routed.select(F.col("key").alias("order_id")), ["order_id"]).count() == 0
    assert {r.topic for r in V.relay(outbox, "outbox.event.{type}").collect()} == {"outbox.event.OrderCreated"}


SAGA = [("order-happy-1", 25.0), ("order-payment-declined-1", 40.0), ("order-out-of-stock-1", 60.0)]


@pytest.fixture(scope="module")
def saga_orders(spark):
    df = spark.createDataFrame([(i, t, T0) for i, t in SAGA], "order_id string, total double, ts timestamp")
    return df.withColumn("items", F.array(F.struct(F.lit("sku").alias("sku"), F.lit(1).alias("qty"))))


def test_saga_outcomes(saga_orders):
    paid = stages.to_payments(saga_orders)
    assert rows(paid, "order_id", "status", "attempts") == [
        ("order-happy-1", "succeeded", 1), ("order-out-of-stock-1", "succeeded", 1), ("order-payment-declined-1", "failed", 1)]
    refunds = stages.to_refunds(stages.to_compensation(paid))
    assert rows(refunds, "order_id", "status") == [("order-out-of-stock-1", "issued")]
    # Refund events come back on the payments topic and must not be reserved again.
    back = paid.select("order_id", "amount", "status", "processed_at").unionByName(stages.refund_events(refunds))
    reserved = stages.to_inventory(back.withColumn("items", F.lit(None).cast("array<string>")))
    assert rows(reserved, "order_id") == [("order-happy-1",)]
    assert stages.to_compensation(back).count() == 1
    shipped = stages.to_shipping(reserved).first()
    assert shipped.tracking_id == "TRK-order-happy-1-1767225600000"


def test_saga_audit_rows(saga_orders):
    audit = stages.orchestrated_audit(saga_orders)
    assert rows(audit.groupBy("order_id").count()) == [
        ("order-happy-1", 4), ("order-out-of-stock-1", 4), ("order-payment-declined-1", 2)]
    assert rows(stages.orchestrated_states(audit)) == [
        ("order-happy-1", "completed"), ("order-out-of-stock-1", "compensated"), ("order-payment-declined-1", "declined")]


def test_claim_check(spark):
    blobs = {"a": b"hello", "b": b"changed"}
    refs = [("a", 5, hashlib.sha256(b"hello").hexdigest()), ("b", 7, hashlib.sha256(b"original").hexdigest()),
            ("c", 1, "x"), ("a", 6, hashlib.sha256(b"hello").hexdigest())]
    r = spark.createDataFrame([(i, *x) for i, x in enumerate(refs)], "i int, key string, size_bytes bigint, checksum string")
    b = spark.createDataFrame([(k, bytearray(v)) for k, v in blobs.items()], "key string, content binary")
    assert rows(claims.redeem(r, b), "i", "status") == [(0, "OK"), (1, "MISMATCH"), (2, "MISSING"), (3, "MISMATCH")]


def test_claim_check_never_shuffles_content(spark):
    r = spark.createDataFrame([("a", 1, "x")], "key string, size_bytes bigint, checksum string")
    b = spark.createDataFrame([("a", bytearray(b"x"))], "key string, content binary")
    plan = claims.redeem(r, b.repartition(4))._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join"):]
    assert "content" not in join.splitlines()[0]


def test_offload_splits_by_size(spark, tmp_path):
    df = spark.createDataFrame([(1, "k1", "x" * 10), (2, "k2", "y" * 100), (3, "k3", "z" * 60)], "id int, key string, body string")
    parts = claims.offload(df, "key", "body", F.col("id").cast("string"), "b", "text/plain", max_bytes=80, record_limit=50)
    assert {n: p.count() for n, p in parts.items()} == {"inline": 1, "rejected": 1, "blobs": 1, "references": 1}
    ref = json.loads(parts["references"].first().value)
    assert ref["checksum"] == hashlib.sha256(b"y" * 100).hexdigest() and ref["sizeBytes"] == 100


def test_blobs_are_fetched_by_key(spark, tmp_path):
    (tmp_path / "attachments").mkdir()
    (tmp_path / "attachments" / "1.bin").write_bytes(b"abc")
    got = [(r.key, bytes(r.content)) for r in read_blobs(spark, str(tmp_path)).collect()]
    assert got == [("attachments/1.bin", b"abc")]


def test_lag(spark):
    log = spark.createDataFrame([("orders", p, o) for p, end in enumerate([8, 4, 4]) for o in range(end)],
                                "topic string, partition int, offset bigint")
    offsets = spark.createDataFrame([("g", "orders", p, c) for p, c in enumerate([4, 2, 2])],
                                    "consumer_group string, topic string, partition int, committed bigint")
    lag = observe.consumer_lag(log, offsets)
    assert rows(lag, "partition", "lag") == [(0, 4), (1, 2), (2, 2)]
    assert rows(observe.group_lag(lag)) == [("g", 8)]


def test_trace_is_one_chain_with_one_root(spark):
    names = ["order.create", "payment.process", "inventory.reserve", "shipping.create"]
    spans = [("t", str(i), None if i == 0 else str(i - 1), n.split(".")[0], n, T0 + dt.timedelta(seconds=2 * i),
              T0 + dt.timedelta(seconds=2 * i + 1)) for i, n in enumerate(names)]
    schema = "trace_id string, span_id string, parent_span_id string, service string, name string, start timestamp, end timestamp"
    deep = [("deep", str(i), None if i == 0 else str(i - 1), "s", "n", T0, T0) for i in range(40)]
    broken = [("broken", "b", "lost", "s", "n", T0, T0)]
    loop = [("loop", "x", "y", "s", "n", T0, T0), ("loop", "y", "x", "s", "n", T0, T0)]
    tree = traces.trace_tree(spark.createDataFrame(spans + deep + broken + loop, schema))
    assert rows(tree.filter("trace_id = 't'"), "span_id", "depth", "link", "root_span_id", "gap_ms") == [
        ("0", 0, "root", "0", None), ("1", 1, "child", "0", 1000.0), ("2", 2, "child", "0", 1000.0), ("3", 3, "child", "0", 1000.0)]
    assert tree.filter("trace_id = 'deep' AND depth = cast(span_id as int) AND root_span_id = '0'").count() == 40
    assert rows(tree.filter("trace_id = 'broken'"), "depth", "link") == [(0, "broken")]
    assert rows(tree.filter("trace_id = 'loop'"), "depth") == [(None,), (None,)]
    assert rows(traces.trace_summary(tree.filter("trace_id = 't'"))) == [("t", 4, 1, 0, 3)]


def test_trace_context_round_trip(spark):
    t, s = "a" * 32, "b" * 16
    df = spark.createDataFrame([({"x": "1"}, "{}"), ({}, json.dumps({"traceContext": {"traceparent": f"00-{t}-{s}-01"}})),
                                ({"traceparent": "nonsense"}, "{}"), (None, None)], "headers map<string,string>, payload string")
    first = df.limit(1).select(inject(F.col("headers"), F.lit(t), F.lit(s)).alias("h")).first().h
    assert first == {"x": "1", "traceparent": f"00-{t}-{s}-01"}
    got = [r.p for r in df.select(parent_of(carried(F.col("headers"), F.col("payload"))).alias("p")).collect()]
    assert got[0] is None and tuple(got[1]) == (t, s) and got[2] is None and got[3] is None


def test_alert_fires_after_hold_and_clears(spark):
    step = dt.timedelta(seconds=5)
    samples = [("dlq", "a", T0 + i * step, 0.0 if i < 2 else 1.0) for i in range(70)]
    df = spark.createDataFrame(samples, "name string, service string, ts timestamp, value double")
    grown = observe.counter_increase(df, ["name", "service"], 300)
    states = [r.state for r in observe.alert_states(grown, ["name", "service"], F.col("increase") > 0, 10).orderBy("ts").collect()]
    # One increment at 10 s: pending for two evaluations, firing until it leaves the 5-minute window.
    assert states[:6] == ["inactive", "inactive", "pending", "pending", "firing", "firing"]
    assert states[61] == "firing" and states[62] == "inactive"


def test_counter_reset_counts_from_zero(spark):
    data = [("c", "a", T0 + dt.timedelta(minutes=i), v) for i, v in enumerate([5.0, 9.0, 2.0, 2.0, 6.0])]
    df = spark.createDataFrame(data, "name string, service string, ts timestamp, value double")
    assert [r.delta for r in observe.counter_deltas(df, ["name", "service"]).orderBy("ts").collect()] == [0.0, 4.0, 2.0, 0.0, 4.0]


SWEEP = {(6, 8): 0.235, (6, 64): 0.196, (12, 8): 0.217, (12, 16): 0.118, (24, 8): 0.208, (24, 16): 0.109}


def test_salt_sweep_reproduces_published_shares(spark):
    n = 250_000
    keyed = spark.range(n).select(
        F.col("id").alias("turn"),
        F.when(F.col("id") % 5 != 0, F.lit("customer-VIP"))
        .otherwise(F.concat(F.lit("customer-"), F.floor(F.col("id") / 5 % 5000).cast("string"))).alias("key"))
    # Deal the hot rows evenly over the salts.
    keyed = keyed.withColumn("turn", F.col("turn") - F.floor(F.col("turn") / 5) - 1)
    sweep = partitions.salt_sweep(keyed, "key", "turn", F.col("key") == "customer-VIP", [6, 12, 24], [8, 16, 64])
    got = {(r.partitions, r.salt_buckets): r.worst_share for r in sweep.collect()}
    for plan, share in SWEEP.items():
        assert abs(got[plan] - share) < 0.005, plan


def test_distribution_of_hot_and_empty_topics(spark):
    log = spark.createDataFrame([(5,)] * 8 + [(0,)] * 2, "partition int")
    got = {r.partition: r for r in partitions.partition_distribution(log, 6).collect()}
    assert got[5].share == 0.8 and got[5].over_healthy and got[5].is_worst
    assert got[0].share == 0.2 and not got[0].over_healthy and got[3].records == 0
    empty = partitions.partition_distribution(log.filter("partition > 9"), 3).collect()
    assert [(r.share, r.is_worst) for r in empty] == [(0.0, False)] * 3


def test_copartition_verdicts(spark):
    a = spark.createDataFrame([("k1", 0), ("k2", 1)], "key string, partition int")
    b = spark.createDataFrame([("k1", 1), ("k2", 1)], "key string, partition int")
    wide = spark.createDataFrame([("k1", 0), ("k2", 4)], "key string, partition int")
    assert partitions.copartition_report(a, a).first().verdict == "co-partitioned"
    assert partitions.copartition_report(a, b).first().verdict == "different partitioner"
    assert partitions.copartition_report(a, wide).first().verdict == "different partition counts"


def test_publish_keeps_per_key_order_and_replaceable_partitioner(spark):
    df = spark.createDataFrame([(f"order-{i % 3}", i) for i in range(30)], "k string, i int")
    records = to_log(df, F.col("k"), F.lit("t"), F.col("i").cast("string"), F.timestamp_seconds(F.col("i"))).withColumn(
        "n", F.col("value").cast("int"))
    log = place(records, 3, ["n"])
    for p in log.select("partition").distinct().collect():
        values = [int(r.value) for r in log.filter(F.col("partition") == p.partition).orderBy("offset").collect()]
        assert values == sorted(values)
        assert [r.offset for r in log.filter(F.col("partition") == p.partition).orderBy("offset").collect()] == list(range(len(values)))
    fixed = place(records, 3, ["n"], partitioner=lambda key, n: F.lit(2))
    assert rows(fixed.select("partition").distinct()) == [(2,)]
    assert kafka_rows(log).schema.simpleString() == (
        "struct<key:string,value:string,topic:string,headers:array<struct<key:string,value:binary>>>")


def test_funnel_17_16_15_15(spark):
    ids = [f"order-{i}" for i in range(15)] + ["order-payment-declined-9"]
    log = spark.createDataFrame([(i, "{}") for i in ids] + [(None, "heyyy")], "key string, value string")
    funnel = stages.chain_funnel(log)
    assert rows(funnel, "stage_no", "records") == [(0, 17), (1, 16), (2, 15), (3, 15), (4, 15)]
    assert rows(funnel.filter("dropped > 0"), "stage", "dropped", "drop_reason") == [
        ("paid", 1, "payment failed"), ("parsed", 1, "not JSON")]


def test_kafka_records_become_envelopes(spark):
    source = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"v"), "t", 1, 5, T0, 0, [("a", bytearray(b"1")), ("b", None), ("a", bytearray(b"2"))]),
         (None, bytearray(b"v"), "t", 1, 6, T0, 0, None)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
        "headers array<struct<key:string,value:binary>>")
    log = from_kafka(source)
    assert log.schema.simpleString() == S.ENVELOPE.simpleString()
    assert [(r.key, r.offset, r.headers) for r in log.collect()] == [("k", 5, {"a": "2", "b": None}), (None, 6, {})]


def test_kafka_options():
    opts = kafka_options("h:1", ["a", "b"], max_per_trigger=5000, min_partitions=12)
    assert opts["subscribe"] == "a,b" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "5000" and opts["minPartitions"] == "12" and "minOffsetsPerTrigger" not in opts


def test_reconcile_names_the_missing_systems(spark):
    def ids(*xs):
        return spark.createDataFrame([(x,) for x in xs], "order_id string")
    got = V.reconcile({"payments": ids("a", "b", "b"), "outbox": ids("a"), "sink": ids("b", "c")}, "order_id")
    assert rows(got, "key", "missing_in") == [("a", "sink"), ("b", "outbox"), ("c", "payments,outbox")]


def test_clustered_files_are_sorted_and_pruned(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "event_type", F.date_format("ts", "yyyyMM").alias("event_month"))
    path = str(tmp_path / "t")
    write_clustered(events, path, "event_month", ["event_type", "event_id"])
    plan = spark.read.parquet(path).filter("event_month = '202401' AND event_type = 'view'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "EqualTo(event_type,view)" in plan


def test_framed_records_are_resolved_to_the_reader(spark):
    v1 = T.StructType().add("id", "string", False).add("qty", "integer")
    v2 = T.StructType().add("key", "string", False).add("qty", "double").add("note", "string")
    reader = T.StructType().add("key", "string", False).add("qty", "double").add("note", "string").add("site", "string", False)
    writers = {1: decode.Writer(v1, {"key": "id"}), 2: decode.Writer(v2)}
    frame = lambda sid, text, magic=0: bytes([magic]) + sid.to_bytes(4, "big") + (text if isinstance(text, bytes) else text.encode())
    rows_in = [(1, frame(1, '{"id":"a","qty":3}')), (2, frame(2, '{"key":"b","qty":2.5,"note":"n"}')), (3, frame(2, '{"key":"c","qty":null}')),
               (4, frame(9, "{}")), (5, frame(1, "{}", 1)), (6, b"\x00\x00"), (7, None), (8, frame(1, "heyyy")), (9, frame(2, b"\xff\xfe")),
               (10, frame(1, '{"qty":3}')), (11, frame(2, '{"key":"d","qty":"much"}')), (12, frame(1, '{"id":"e","extra":1}')), (13, frame(2, "[1]"))]
    df = spark.createDataFrame(rows_in, "no int, body binary")
    got = {r.no: tuple(r)[1:] for r in decode.read_framed(df, writers, reader, {"site": F.lit("web")}).collect()}
    none = (None,) * 4
    assert got == {
        1: (1, None, "a", 3.0, None, "web"), 2: (2, None, "b", 2.5, "n", "web"), 3: (2, None, "c", None, None, "web"), 4: (9, "unknown schema", *none),
        5: (None, "not framed", *none), 6: (None, "not framed", *none), 7: (None, "not framed", *none), 8: (1, "not JSON", *none), 9: (2, "not JSON", *none),
        10: (1, "misfit: id", *none), 11: (2, "misfit: qty", *none), 12: (1, None, "e", None, None, "web"), 13: (2, "misfit: key", *none)}
    with pytest.raises(gate.IncompatibleSchema, match="site"):
        decode.read_framed(df, writers, reader)
    with pytest.raises(gate.IncompatibleSchema, match="qty"):
        decode.read_framed(df, writers, T.StructType().add("key", "string").add("qty", "integer"))
    plan = decode.read_framed(df, writers, reader, {"site": F.lit("web")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parse_json") <= 2  # parsed once, whatever is read from it


def test_contexts_are_derived_and_rebuilt(spark):
    from logtide.functions import tracecontext as C
    from logtide.operators import services
    assert spark.range(1).select(C.child_of(F.lit("no context"), F.lit("x")).alias("c")).first().c is None
    sends = spark.createDataFrame([("order-happy-1", '{"orderId":"order-happy-1","total":5.0}', "orders", 0, o, dt.datetime(2026, 1, 1)) for o in (0, 9)] + [
        ("order-out-of-stock-2", '{"orderId":"order-out-of-stock-2","total":2.0}', "orders", 1, 0, dt.datetime(2026, 1, 1))],
        "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    outbox = services.order_service(sends)
    for serve in (services.payment_service, services.inventory_service, services.payment_service, services.shipping_service):
        known = outbox.select("id")
        outbox = outbox.unionByName(serve(services.relayed(outbox)).join(known, "id", "left_anti"))
    assert rows(outbox, "type") == sorted([("OrderCreated",)] * 3 + [("PaymentSucceeded",)] * 3 + [("InventoryReserved",), ("ShipmentCreated",)] * 2 + [
        ("CompensationRequested",), ("PaymentRefunded",)], key=repr)
    assert outbox.select("id").distinct().count() == outbox.count()
    assert outbox.where("payload NOT LIKE '%traceContext%'").count() == 0
    spans = services.published_spans(services.relayed(outbox)).collect()
    assert len({s.trace_id for s in spans}) == 3 and len({(s.trace_id, s.span_id) for s in spans}) == len(spans)
    name = {(s.trace_id, s.span_id): s.name for s in spans}
    assert Counter((name.get((s.trace_id, s.parent_span_id)), s.name) for s in spans) == {
        (None, "order.create"): 3, ("order.create", "payment.process"): 3, ("payment.process", "inventory.reserve"): 3, ("inventory.reserve", "shipping.create"): 2,
        ("inventory.reserve", "payment.compensate"): 1}


def test_one_pass_sink_sorts_out_and_keeps_lines_whole(spark, tmp_path):
    log = spark.createDataFrame([("a", '{"x":\n 1,\r\n"s":"two words"}', 0), ("b", "heyyy\nyou", 1), ("c", None, 2), ("d", "[1]", 3)], "key string, value string, offset long")
    path = str(tmp_path / "out")
    write_sorted_out(log, path)
    write_sorted_out(log.where("offset = 3"), path)
    assert sorted(json.dumps(json.loads(r.value)) for r in read_sink_lines(spark, path).collect()) == ["[1]", "[1]", '{"x": 1, "s": "two words"}']
    held = {r.key: (r.value, r.offset, r.reject_reason) for r in read_quarantine(spark, path, log.schema).collect()}
    assert held["b"][:2] == ("heyyy\nyou", 1) and held["c"][:2] == (None, 2) and all(v[2] for v in held.values()) and len(held) == 2
