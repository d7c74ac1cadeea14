"""Queries over the order chain, retries and the saga."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.functions import rules as R
from logtide.operators import stages as G
from logtide.operators.retry import message_outcomes, retry_plan
from logtide.plans import derived as D
from logtide.plans.registry import query


@query("pipe_payments", """
    SELECT order_id, round(amount, 2) AS amount, status, CAST(attempts AS INTEGER) AS attempts, paid_at AS processed_at,
           coalesce(n, 0) AS n_items
    FROM f_payments LEFT JOIN (SELECT order_no, count(*) AS n FROM f_items GROUP BY order_no) USING (order_no)""",
       ("f_payments", "f_items"))
def pipe_payments(spark: SparkSession, sf: str) -> DataFrame:
    return D.payments(spark, sf, with_items=True).select(
        "order_id", F.round("amount", 2).alias("amount"), "status", "attempts", "processed_at",
        F.size("items").cast("bigint").alias("n_items"))


_RESERVED = """
    SELECT order_id, coalesce(items, '[]') AS items, true AS reserved, paid_at AS reserved_at
    FROM f_payments LEFT JOIN (
        SELECT l_orderkey AS order_no, '[' || string_agg('{"sku":"sku-' || l_partkey || '","qty":' || CAST(l_quantity AS INTEGER) || '}',
                                                        ',' ORDER BY l_linenumber, l_partkey, l_quantity) || ']' AS items
        FROM lineitem GROUP BY l_orderkey) USING (order_no)
    WHERE status = 'succeeded' AND scenario <> 'out-of-stock'"""


@query("pipe_inventory", _RESERVED, ("f_payments",))
@query("pipe_inventory_items", _RESERVED, ("f_payments",))
def pipe_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Reservations with the items that they carry, as JSON. The refund events of the topic are in its input and go no further."""
    paid = D.payments(spark, sf, with_items=True)
    refunds = G.refund_events(D.refunds(spark, sf)).withColumn("items", F.lit(None).cast(paid.schema["items"].dataType)).withColumn("attempts", F.lit(None).cast("int"))
    return G.to_inventory(paid.unionByName(refunds)).withColumn("items", F.to_json("items"))


_TRACKING = "'TRK-' || order_id || '-' || epoch_ms({0})"


@query("pipe_shipping", f"""
    SELECT order_id, {_TRACKING.format('paid_at')} AS tracking_id, paid_at AS shipped_at FROM f_payments
    WHERE status = 'succeeded' AND scenario <> 'out-of-stock'""", ("f_payments",))
def pipe_shipping(spark: SparkSession, sf: str) -> DataFrame:
    return G.to_shipping(G.to_inventory(D.payments(spark, sf)))


@query("saga_compensation", """
    SELECT order_id, 'inventory reservation failed: out of stock' AS reason, paid_at AS requested_at
    FROM f_payments WHERE scenario = 'out-of-stock'""", ("f_payments",))
def saga_compensation(spark: SparkSession, sf: str) -> DataFrame:
    return D.compensation(spark, sf)


@query("saga_refunds", """
    SELECT order_id, 'inventory reservation failed: out of stock' AS reason, 'issued' AS status,
           paid_at + INTERVAL 60 SECONDS AS issued_at
    FROM f_payments WHERE scenario = 'out-of-stock'""", ("f_payments",))
def saga_refunds(spark: SparkSession, sf: str) -> DataFrame:
    return D.refunds(spark, sf)


@query("saga_audit", f"""
    SELECT order_id, CAST(i - 1 AS INTEGER) AS seq, steps[i] AS step, details[i] AS detail FROM (
      SELECT order_id, unnest(range(1, len(steps) + 1)) AS i, steps, details FROM (
        SELECT order_id,
          CASE scenario WHEN 'payment-declined' THEN ['payment', 'saga-ended']
                        WHEN 'out-of-stock' THEN ['payment', 'inventory', 'compensate-payment', 'saga-ended']
                        ELSE ['payment', 'inventory', 'shipment', 'saga-ended'] END AS steps,
          CASE scenario WHEN 'payment-declined' THEN ['failed', 'payment declined, no further steps']
                        WHEN 'out-of-stock' THEN ['succeeded', 'out-of-stock', 'inventory reservation failed: out of stock',
                                                  'compensated: payment refunded after inventory failure']
                        ELSE ['succeeded', 'reserved', {_TRACKING.format('ts')}, 'completed'] END AS details
        FROM f_orders))""", ("f_orders",))
def saga_audit(spark: SparkSession, sf: str) -> DataFrame:
    return G.orchestrated_audit(D.orders(spark, sf))


def has_shipped():
    """The last hop is still running: every 41st reserved order has not been shipped yet."""
    return D.order_no() % 41 != 0


def chain_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events of all topics as (order_id, topic, status), from one pass over the orders."""
    oid, status = F.col("order_id"), F.col("status")
    paid = status == "succeeded"
    reserved = paid & ~R.is_out_of_stock(oid)

    def event(topic: str, text, happened):
        return F.struct(F.lit(topic).alias("topic"), text.cast("string").alias("status"), happened.alias("happened"))

    none = F.lit(None)
    events = F.array(
        event("orders", none, F.lit(True)),
        event("payments", status, F.lit(True)),
        event("payments", F.lit("refunded"), paid & R.is_out_of_stock(oid)),
        event("payments-dlq", none, ~paid & ~R.is_declined(oid)),
        event("inventory", none, reserved),
        event("shipping", none, reserved & has_shipped()))
    return D.payments(spark, sf).select("order_id", F.inline(events)).filter("happened").drop("happened")


@query("saga_terminal", """
    SELECT order_id, CASE WHEN scenario = 'payment-declined' THEN 'declined' WHEN scenario = 'out-of-stock' THEN 'compensated'
                          WHEN scenario = 'permanent-fail' THEN 'dead-lettered'
                          WHEN order_no % 41 = 0 THEN 'in-flight' ELSE 'completed' END AS state
    FROM f_orders""", ("f_orders",))
def saga_terminal(spark: SparkSession, sf: str) -> DataFrame:
    return G.terminal_states(chain_events(spark, sf))


@query("saga_equivalence", """
    SELECT *, orchestrated AS choreographed, true AS agree FROM (
      SELECT order_id, CASE scenario WHEN 'payment-declined' THEN 'declined' WHEN 'out-of-stock' THEN 'compensated'
                                     WHEN 'permanent-fail' THEN 'dead-lettered'
                                     ELSE CASE WHEN order_no % 41 = 0 THEN 'in-flight' ELSE 'completed' END END AS orchestrated
      FROM f_orders)""", ("f_orders",))
def saga_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """End state of every order by its events and by the orchestrator's audit, from the same payments and shipments."""
    paid = D.payments(spark, sf)
    gave_up = (F.col("status") == "failed") & ~R.is_declined(F.col("order_id"))
    audit = G.orchestrated_audit(paid, "processed_at", gave_up, has_shipped())
    both = G.state_agreement(G.terminal_states(chain_events(spark, sf)), G.orchestrated_states(audit))
    return both.select("order_id", F.col("left_state").alias("choreographed"), F.col("right_state").alias("orchestrated"), "agree")


@query("retry_attempts", """
    SELECT order_id, CAST(k AS INTEGER) AS attempt,
           CASE WHEN scenario = 'permanent-fail' AND k = 3 THEN 'exhausted'
                WHEN scenario = 'permanent-fail' OR (scenario = 'transient-fail' AND k < 3) THEN 'retry'
                ELSE 'success' END AS outcome,
           CASE WHEN scenario = 'permanent-fail'
                THEN 'downstream rejected ' || order_id || ' (attempt ' || k || ') — simulated permanent outage'
                WHEN scenario = 'transient-fail' AND k < 3
                THEN 'downstream timeout for ' || order_id || ' (attempt ' || k || '/3)' END AS failure_reason,
           CAST([0, 200, 400][k] AS BIGINT) AS backoff_ms, CAST([0, 200, 600][k] AS BIGINT) AS waited_ms
    FROM f_orders, (SELECT unnest([1, 2, 3]) AS k)
    WHERE scenario <> 'payment-declined' AND (k = 1 OR scenario IN ('transient-fail', 'permanent-fail'))""", ("f_orders",))
def retry_attempts(spark: SparkSession, sf: str) -> DataFrame:
    called = D.orders(spark, sf).select("order_id").filter(~R.is_declined(F.col("order_id")))
    return retry_plan(called, R.attempt_failure)


@query("retry_outcomes", """
    SELECT CASE scenario WHEN 'permanent-fail' THEN 'exhausted' WHEN 'transient-fail' THEN 'retry' ELSE 'success' END AS outcome,
           count(*) AS messages
    FROM f_orders WHERE scenario <> 'payment-declined' GROUP BY ALL""", ("f_orders",))
def retry_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    called = D.orders(spark, sf).filter(~R.is_declined(F.col("order_id")))
    return message_outcomes(called).groupBy("outcome").agg(F.count("*").alias("messages"))


@query("stage_funnel", """
    , c AS (SELECT count(*) AS o, count(*) FILTER (WHERE order_no % 97 <> 0) AS good,
                   count(*) FILTER (WHERE order_no % 97 <> 0 AND status = 'succeeded') AS paid,
                   count(*) FILTER (WHERE order_no % 97 <> 0 AND status = 'succeeded' AND scenario <> 'out-of-stock') AS kept
            FROM f_payments)
    SELECT 0 AS stage_no, 'received' AS stage, o AS records, 0::BIGINT AS dropped, NULL::VARCHAR AS drop_reason FROM c
    UNION ALL SELECT 1, 'parsed', good, o - good, 'not JSON' FROM c
    UNION ALL SELECT 2, 'paid', paid, good - paid, 'payment failed' FROM c
    UNION ALL SELECT 3, 'reserved', kept, paid - kept, 'out of stock' FROM c
    UNION ALL SELECT 4, 'shipped', kept, 0, NULL FROM c""", ("f_payments",))
def stage_funnel_query(spark: SparkSession, sf: str) -> DataFrame:
    """Counts along the chain, starting from a log with poison records."""
    received = D.log_orders(spark, sf).withColumn(
        "value", F.when(D.order_no("key") % 97 == 0, F.lit("heyyy")).otherwise(F.col("value")))
    return G.chain_funnel(received)


STAGES = ["orders", "payments", "inventory", "shipping"]


def hops(spark: SparkSession, sf: str) -> DataFrame:
    """Event times per hop: inventory two seconds after payment, shipping a few seconds later."""
    paid = D.payments(spark, sf)
    reserved = G.to_inventory(paid)
    def at(col: str, seconds) -> F.Column:
        return F.timestamp_seconds(F.unix_seconds(col) + seconds).alias("ts")
    return (
        D.orders(spark, sf).select("order_id", F.lit("orders").alias("stage"), "ts")
        .unionByName(paid.select("order_id", F.lit("payments").alias("stage"), F.col("processed_at").alias("ts")))
        .unionByName(reserved.select("order_id", F.lit("inventory").alias("stage"), at("reserved_at", F.lit(2))))
        .unionByName(reserved.select("order_id", F.lit("shipping").alias("stage"),
                                     at("reserved_at", 2 + D.order_no() % 9)))
    )


_HOPS = """
    , hops AS (
      SELECT order_id, 0 AS stage_no, 'orders' AS stage, order_ts AS ts FROM f_payments
      UNION ALL SELECT order_id, 1, 'payments', paid_at FROM f_payments
      UNION ALL SELECT order_id, 2, 'inventory', paid_at + INTERVAL 2 SECONDS FROM f_payments
                WHERE status = 'succeeded' AND scenario <> 'out-of-stock'
      UNION ALL SELECT order_id, 3, 'shipping', paid_at + to_seconds(CAST(2 + order_no % 9 AS BIGINT)) FROM f_payments
                WHERE status = 'succeeded' AND scenario <> 'out-of-stock')"""


@query("stage_latency", _HOPS + """
    SELECT order_id, CAST(stage_no AS INTEGER) AS stage_no, stage, ts,
           epoch(ts - lag(ts) OVER (PARTITION BY order_id ORDER BY stage_no)) AS delay_seconds
    FROM hops""", ("f_payments",))
def stage_latency_query(spark: SparkSession, sf: str) -> DataFrame:
    return G.stage_latency(hops(spark, sf), STAGES)


@query("saga_story", _HOPS + """
    , steps AS (
      SELECT order_id, stage AS step, ts, stage_no AS rank FROM hops
      UNION ALL SELECT order_id, 'compensation', paid_at, 4 FROM f_payments WHERE scenario = 'out-of-stock'
      UNION ALL SELECT order_id, 'refund', paid_at + INTERVAL 60 SECONDS, 5 FROM f_payments WHERE scenario = 'out-of-stock')
    SELECT order_id, CAST(row_number() OVER (PARTITION BY order_id ORDER BY ts, rank) AS INTEGER) AS story_no, step, ts AS at
    FROM steps""", ("f_payments",))
def saga_story_query(spark: SparkSession, sf: str) -> DataFrame:
    """What happened to each order: the stages it reached, and where stock was out, the compensation asked for and the refund."""
    step = lambda name, at: (F.col("order_id"), F.lit(name).alias("stage"), F.col(at).alias("ts"))
    told = hops(spark, sf).unionByName(D.compensation(spark, sf).select(*step("compensation", "requested_at"))).unionByName(
        D.refunds(spark, sf).select(*step("refund", "issued_at")))
    rank = F.array_position(F.array(*[F.lit(s) for s in [*STAGES, "compensation", "refund"]]), F.col("stage"))
    return G.saga_story(told.select("order_id", F.col("stage").alias("step"), F.col("ts").alias("at"), rank.alias("rank")))
