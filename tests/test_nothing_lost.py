"""Records that an operator cannot use are returned or shown, never dropped."""

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logtide import schemas as S
from logtide.operators import decode, partitions, stages
from logtide.plans import QUERIES
from logtide.plans.delivering import payment_effects
from logtide.operators.gate import IncompatibleSchema
from logtide.sinks.tables import gated_append, read_evolved
from logtide.sources.tables import table


def test_unread_versions_and_undeclared(spark):
    log = spark.createDataFrame([(1, 1, '{"orderId": "a"}'), (2, 7, '{"orderId": "b"}'), (3, 1, "heyyy"), (4, None, "{}"), (5, 1, None)],
                                "offset long, schema_id int, value string")
    read = {r.offset for r in decode.read_versions(log, {1: S.ORDER_V1, 2: S.ORDER_V2}, keep=("offset",)).collect()}
    left = {r.offset: r.reason for r in decode.unread_versions(log, {1: S.ORDER_V1, 2: S.ORDER_V2}).collect()}
    assert read | set(left) == {1, 2, 3, 4, 5} and not read & set(left)
    assert left[2] == left[4] == "unknown version" and 1 in read
    good = {r.offset for r in decode.declare(log, S.ORDER, keep=("offset",)).collect()}
    bad = {r.offset for r in decode.undeclared(log, S.ORDER).collect()}
    assert good | bad == {1, 2, 3, 4, 5} and not good & bad and 3 in bad


def test_partition_distribution_shows_strays(spark):
    log = spark.createDataFrame([(0,), (1,), (9,), (None,)], "partition int")
    got = {r.partition: (r.records, r.share) for r in partitions.partition_distribution(log, 3).collect()}
    assert got == {0: (1, 0.25), 1: (1, 0.25), 2: (0, 0.0), 9: (1, 0.25), None: (1, 0.25)}


def test_story_tells_repeats_and_latency_bridges_gaps(spark):
    t = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    steps = spark.createDataFrame([("o", "paid", t(1), 1), ("o", "paid", t(3), 1), ("o", "paid", t(3), 1), ("o", "made", t(0), 0)],
                                  "order_id string, step string, at timestamp, rank int")
    assert [(r.story_no, r.step) for r in stages.saga_story(steps).orderBy("story_no").collect()] == [(1, "made"), (2, "paid"), (3, "paid"), (4, "paid")]
    hops = spark.createDataFrame([("o", "orders", t(0)), ("o", "inventory", t(10))], "order_id string, stage string, ts timestamp")
    assert {r.stage: r.delay_seconds for r in stages.stage_latency(hops, ["orders", "payments", "inventory"]).collect()} == {"orders": None, "inventory": 10.0}


@pytest.mark.parametrize("old, new, value", [("int", "double", 3.7), ("int", "bigint", 3_000_000_000), ("float", "double", 0.1), ("tinyint", "float", 2.5)])
def test_wider_batches_come_back(spark, tmp_path, old, new, value):
    """The gate's one answer: what it accepts is stored and read in the wider type."""
    path = str(tmp_path / "t")
    one = lambda v, kind: spark.range(1).select(F.lit(v).cast(kind).alias("qty"))
    one(1, old).write.parquet(path)
    gated_append(one(value, new), path)
    gated_append(one(2, old), path)  # narrow again: goes with the wide files
    gated_append(one(value, new).withColumn("note", F.when(F.col("qty") > 0, "x")), path)
    back = read_evolved(spark, path)
    assert back.schema["qty"].dataType.simpleString() == new and back.columns == ["qty", "note"]
    assert sorted(r.qty for r in back.collect()) == sorted([1, 2, value, value])
    assert back.where(F.col("qty") == F.lit(value).cast(new)).count() == 2 and back.where("note = 'x'").count() == 1


@pytest.mark.parametrize("old, new, value", [("bigint", "double", 0.5), ("int", "float", 0.5), ("double", "bigint", 2 ** 60), ("int", "string", "x")])
def test_what_would_lose_digits_is_refused_whole(spark, tmp_path, old, new, value):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "qty int").select(F.col("qty").cast(old).alias("qty")).write.parquet(path)
    with pytest.raises(IncompatibleSchema, match="qty"):
        gated_append(spark.createDataFrame([(value,)], f"qty {new}"), path)
    assert read_evolved(spark, path).count() == 1


def test_agreement_shows_planted_differences(spark):
    left = spark.createDataFrame([("a", "completed"), ("b", "declined"), ("c", "completed")], "order_id string, state string")
    right = spark.createDataFrame([("a", "completed"), ("b", "compensated"), ("d", "declined")], "order_id string, state string")
    assert {r.order_id: r.agree for r in stages.state_agreement(left, right).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_order_sent_again_has_its_own_outbox_row(spark):
    value = '{"orderId": "order-happy-1", "total": 5.0}'
    fresh = spark.createDataFrame([("orders", 0, 1, value), ("orders", 0, 9, value)], "topic string, partition int, offset long, value string")
    ids = [r.id for r in payment_effects(fresh.selectExpr("*", "timestamp'2026-01-01 00:00:00' AS timestamp"))["outbox"].collect()]
    assert len(ids) == len(set(ids)) == 2


def test_every_order_has_a_trace_and_every_reserved_order_its_items(spark, sf):
    """By counts over the tables alone: spans per scenario, and items of what is reserved."""
    hops = {0: 4, 1: 3, 2: 5, 3: 4, 4: 3}
    keys = [r.o_orderkey for r in table(spark, sf, "orders").select("o_orderkey").collect()]
    spans = {r[0]: r[1] for r in QUERIES["trace_tree_all"].plan(spark, sf).groupBy("trace_id").count().collect()}
    assert sorted((int(t.rsplit("-", 1)[1]), n) for t, n in spans.items()) == sorted((k, hops[k % 5] - (k % 200 == 0)) for k in keys)
    items = {r.order_id: len(json.loads(r["items"])) for r in QUERIES["pipe_inventory_items"].plan(spark, sf).collect()}
    lines = Counter(r.l_orderkey for r in table(spark, sf, "lineitem").select("l_orderkey").collect())
    assert {int(k.rsplit("-", 1)[1]): n for k, n in items.items()} == {k: lines[k] for k in keys if k % 5 in (0, 3)}
    assert sum(items.values()) > 0
