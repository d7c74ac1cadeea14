"""What keeps queries within their limits on large tables, seen on small ones."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from logtide.operators import services
from logtide.operators.ordered import chunk_of, chunked_positions
from logtide.plans import QUERIES
from logtide.plans import derived as D
from logtide.session import scratch_dir


def test_chunks_are_found_by_halving(spark):
    points = [(None, 1), (None, 5), (1, 0), (1, 0), (2, 3), (2, None), (9, 9), (7, 1)]
    df = spark.createDataFrame(points, "a int, b int")
    key = lambda r: [(x is not None, x or 0) for x in r]
    for n in range(1, 10):
        cuts = [(None, 5), (1, 0), (1, 7), (2, 2), (2, 3), (3, None), (5, 5), (7, 1), (8, 0)][:n]
        column = F.array(*[F.struct(*[F.lit(x).cast("int").alias(c) for x, c in zip(cut, "ab")]) for cut in cuts])
        got = df.select("a", "b", chunk_of(F.struct("a", "b"), column, n).alias("c")).collect()
        assert [r.c for r in got] == [sum(key(cut) <= key((r.a, r.b)) for cut in cuts) for r in got]


def test_chunks_are_computed_once_in_a_plan(spark):
    """No filter repeats them at the scan, and the steps of a search share the place that they compare."""
    df = spark.range(200).select(F.concat(F.lit("k-"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7).alias("t"))
    no = F.substring_index("key", "-", -1).cast("bigint")
    numbered = chunked_positions(df.withColumn("no", no), [], ["t", "no"], "at", chunks=8)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and "isnotnull(" not in plan.split("Window")[1]
    assert "substring_index" not in plan.split("aggregate(")[1].split("AS _chunk")[0]
    assert sorted(r["at"] for r in numbered.collect()) == list(range(200))


def test_applied_offsets_are_counted_not_joined(spark, sf):
    """A ledger of few ranges expands to every offset of the log; a join would broadcast it by the size of its file."""
    plan = QUERIES["batched_idempotent"].plan(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" in plan and not re.search(r"Join Inner, .*offset", plan)


def test_outbox_rows_are_written_once(spark, sf):
    count = D.published_events(spark, sf).count()
    folder = os.path.join(scratch_dir(spark), "logtide", spark.sparkContext.applicationId)
    tables = [f for f in os.listdir(folder) if f.startswith("outbox")]
    rows = sum(spark.read.option("recursiveFileLookup", "true").parquet(os.path.join(folder, f)).count() for f in tables)
    assert rows == count * len(tables) and len(tables) == 1


def test_spans_offer_the_hop_of_their_topics_consumer(spark):
    sends = spark.createDataFrame([("order-happy-1", '{"orderId":"order-happy-1","total":5.0}', "orders", 0, 7, dt.datetime(2026, 1, 1))],
                                  "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    made = services.relayed(services.order_service(sends))
    paid = services.relayed(services.payment_service(made))
    records = made.unionByName(paid)
    offered = services.published_spans(records)
    assert {(r.name, r.parent_span_id is None) for r in offered.collect()} == {("order.create", True), ("payment.process", False)}
    # A topic of another consumer may lead to any hop.
    elsewhere = records.withColumn("topic", F.concat(F.lit("eu-"), F.col("topic")))
    assert sorted(map(tuple, services.published_spans(elsewhere).collect()), key=repr) == sorted(map(tuple, offered.collect()), key=repr)
    assert set(services.CONSUMED.values()) == set(services.HOPS.values()) - {"order.create"}


def test_payloads_are_parsed_once(spark, sf):
    """A hop parses a record once, whatever it reads of it, and so does a consumer of the relay."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    records = services.relayed(D.published_events(spark, sf))
    for df, parses in ((QUERIES["outbox_relay"].plan(spark, sf), 1), (services.payment_service(records), 2), (services.inventory_service(records), 2),
                       (services.shipping_service(records), 1), (services.published_spans(records), 2)):
        assert (plan(df).count("from_json("), plan(df).count("get_json_object(")) == (parses, 0)


def test_a_log_sent_again_is_read_once_and_lines_move_without_text(spark, sf):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(QUERIES["dedup_delivery_vs_business"].plan(spark, sf)).count("Relation [") == 1
    dealt = plan(D.full_orders(spark, sf)).split("RepartitionByExpression [order_no")[1]
    assert "sku-" not in dealt and "l_partkey" in dealt
