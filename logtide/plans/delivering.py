"""Queries over delivery guarantees, upserts, audits and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide.operators import delivery as V
from logtide.operators.ordered import chunked_lag, chunked_lead, offset_chunk
from logtide.operators.stages import to_payments
from logtide.plans import derived as D
from logtide.plans.registry import query
from logtide.session import scratch_path
from logtide.sinks.log import place, to_log
from logtide.streaming.commits import LEDGER, CommitStore, idempotent_batch
from logtide.streaming.jobs import LatestTable, lookup


@query("assign_offsets", """
    SELECT order_id AS key, part AS "partition", pos AS "offset", pos + 1 AS next_offset FROM f_log_orders""",
       ("f_log_orders",))
def assign_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Placement and numbering of the orders topic, computed here rather than read from the stored log."""
    records = to_log(D.orders(spark, sf), F.col("order_id"), F.lit("orders"), F.col("customer_id"), F.col("ts"))
    log = place(records.withColumn("_no", D.order_no("key")), D.PARTITIONS, ["timestamp", "_no"])
    return log.select("key", "partition", "offset", (F.col("offset") + 1).alias("next_offset"))


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    """The skewed events as a log in send order; every 11th producer clock is an hour behind."""
    def build() -> DataFrame:
        late = F.when(F.col("event_id") % 11 == 0, F.lit(3_600_000_000)).otherwise(F.lit(0))
        at = F.timestamp_micros(F.unix_micros("ts") - late)
        records = to_log(D.skewed(spark, sf), F.col("key"), F.lit("events"), F.col("event_id").cast("string"), at)
        return place(records.withColumn("_no", F.col("value").cast("bigint")), 6, ["_no"])
    return D.once(spark, sf, "log-events", build)


@query("key_order_check", """
    SELECT key, event_id, sent_at AS "timestamp", prev_at AS prev_timestamp FROM (
      SELECT *, lag(sent_at) OVER (PARTITION BY key ORDER BY event_id) AS prev_at FROM (
        SELECT key, event_id, ts - CASE WHEN event_id % 11 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS sent_at
        FROM f_skewed))
    WHERE sent_at < prev_at""", ("f_skewed",))
def key_order_check(spark: SparkSession, sf: str) -> DataFrame:
    log = event_log(spark, sf)
    lagged = chunked_lag(log, ["topic", "partition", "key"], ["offset"], ["timestamp"], offset_chunk())
    return lagged.filter(F.col("timestamp") < F.col("prev_timestamp")).select(
        "key", F.col("value").cast("bigint").alias("event_id"), "timestamp", "prev_timestamp")


def at_most_once(log: DataFrame) -> DataFrame:
    """Effects of a consumer that committed first and then crashed at offsets ending in 2."""
    return log.filter(F.col("offset") % 10 != 2).select(*V.DELIVERY)


@query("delivery_gaps", """
    SELECT part AS "partition", pos AS after_offset, nxt AS next_offset, nxt - pos - 1 AS missing
    FROM (SELECT part, pos, lead(pos) OVER (PARTITION BY part ORDER BY pos) AS nxt FROM f_log_orders WHERE pos % 10 <> 2)
    WHERE nxt - pos > 1""", ("f_log_orders",))
def delivery_gaps(spark: SparkSession, sf: str) -> DataFrame:
    effects = at_most_once(D.log_orders(spark, sf)).withColumn("at", F.col("offset"))
    ahead = chunked_lead(effects, ["topic", "partition"], ["offset"], ["at"], offset_chunk())
    return ahead.filter(F.col("next_at") - F.col("offset") > 1).select(
        "partition", F.col("offset").alias("after_offset"), F.col("next_at").alias("next_offset"),
        (F.col("next_at") - F.col("offset") - 1).alias("missing"))


@query("delivery_dups", """
    SELECT part AS "partition", pos AS "offset", count(*) AS effects FROM f_deliveries GROUP BY ALL HAVING count(*) > 1""",
       ("f_deliveries",))
def delivery_dups(spark: SparkSession, sf: str) -> DataFrame:
    counted = D.deliveries(D.log_orders(spark, sf)).groupBy(*V.DELIVERY).agg(F.count("*").alias("effects"))
    return counted.filter(F.col("effects") > 1).select("partition", "offset", "effects")


@query("delivery_audit", """
    SELECT run, part AS "partition", pos AS "offset", CAST(n AS BIGINT) AS effects,
           CASE n WHEN 0 THEN 'lost' WHEN 1 THEN 'ok' ELSE 'duplicate' END AS verdict
    FROM (SELECT 'commit-first' AS run, part, pos, CASE WHEN pos % 10 = 2 THEN 0 ELSE 1 END AS n FROM f_log_orders
          UNION ALL SELECT 'commit-last', part, pos, CASE WHEN pos % 10 = 3 THEN 2 ELSE 1 END FROM f_log_orders)""",
       ("f_log_orders",))
def delivery_audit_query(spark: SparkSession, sf: str) -> DataFrame:
    log = D.log_orders(spark, sf)
    runs = {"commit-first": at_most_once(log), "commit-last": D.deliveries(log)}
    parts = [V.delivery_audit(log.select(*V.DELIVERY), effects).select(
        F.lit(run).alias("run"), "partition", "offset", "effects", "verdict") for run, effects in runs.items()]
    return parts[0].unionByName(parts[1])


@query("idempotent_outcomes", """
    SELECT order_id AS key, part AS "partition", pos AS "offset", seq AS delivery_seq,
           CASE seq WHEN 1 THEN 'applied' ELSE 'duplicate' END AS outcome
    FROM f_deliveries""", ("f_deliveries",))
def idempotent_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return V.delivery_outcomes(D.deliveries(D.log_orders(spark, sf)).drop("value", "headers")).select(
        "key", "partition", "offset", "delivery_seq", "outcome")


@query("ledger_antijoin", """
    SELECT order_id AS key, part AS "partition", pos AS "offset" FROM f_log_orders WHERE pos % 4 = 0""", ("f_log_orders",))
def ledger_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries against a ledger that lacks every 4th offset."""
    log = D.log_orders(spark, sf).select("key", *V.DELIVERY)
    ledger = log.filter(F.col("offset") % 4 != 0)
    batch = V.distinct_deliveries(D.deliveries(log), "delivery_seq")
    return V.new_deliveries(batch, ledger).select("key", "partition", "offset")


BATCHES = 2  # of first copies; one more takes the last redeliveries


def effects_schema() -> dict[str, T.StructType]:
    return {
        "ledger": LEDGER,
        "payments": T.StructType().add("order_id", "string").add("amount", "double").add("status", "string")
        .add("attempts", "integer").add("partition", "integer").add("offset", "long"),
        "outbox": T.StructType().add("id", "string").add("aggregatetype", "string").add("aggregateid", "string")
        .add("type", "string").add("payload", "string"),
    }


def payment_effects(fresh: DataFrame) -> dict[str, DataFrame]:
    """Payment rows and their outbox rows for new order deliveries."""
    orders = fresh.select(
        F.get_json_object("value", "$.orderId").alias("order_id"), F.lit(None).cast("array<string>").alias("items"),
        F.get_json_object("value", "$.total").cast("double").alias("total"), F.col("timestamp").alias("ts"),
        *V.DELIVERY)
    # One delivery is one order: the payment keeps the coordinates of its delivery.
    paid = to_payments(orders, extra=tuple(V.DELIVERY))
    event = F.when(F.col("status") == "succeeded", "PaymentSucceeded").otherwise("PaymentFailed")
    outbox = V.outbox_rows(paid, "payments", "order_id", event, F.to_json(F.struct(
        event.alias("type"), F.col("order_id").alias("orderId"), "amount", "status")), tuple(V.DELIVERY))
    return {"payments": paid.drop("topic"), "outbox": outbox}


@query("batched_idempotent", """
    SELECT order_id, round(total, 2) AS amount,
           CASE WHEN scenario IN ('payment-declined', 'permanent-fail') THEN 'failed' ELSE 'succeeded' END AS status,
           CAST(CASE WHEN scenario IN ('transient-fail', 'permanent-fail') THEN 3 ELSE 1 END AS BIGINT) AS retry_attempts,
           1 AS ledger_rows, 1 AS outbox_rows
    FROM f_log_orders""", ("f_log_orders",))
def batched_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches of neighbouring offsets in which redelivered records come again one batch later."""
    log = D.log_orders(spark, sf)
    store = CommitStore(spark, scratch_path(spark, "batched"), effects_schema())
    apply = idempotent_batch(store, payment_effects, seq="delivery_seq")
    size = -(-(log.agg(F.max("offset")).first()[0] + 1) // BATCHES)
    delivered = D.with_batch(D.deliveries(log), size)
    for batch_id in range(BATCHES + 1):
        apply(delivered.filter(F.col("batch_id") == batch_id).drop("batch_id"), batch_id)
    state = V.payments_state(store.committed("payments"), ["partition", "offset"])
    outbox = store.committed("outbox").groupBy(F.col("aggregateid").alias("order_id")).agg(F.count("*").cast("int").alias("outbox_rows"))
    applied = store.committed("ledger").select("topic", "partition", F.explode(F.sequence("from_offset", "to_offset")).alias("offset"))
    # Counted with the log in one aggregate: a few ranges stand for as many offsets as the log has, so a join would take the
    # side that they expand to for a small one and send it through the driver.
    counted = V.delivery_audit(log.select("key", *V.DELIVERY), applied).where("effects > 0")
    ledger = counted.groupBy(F.col("key").alias("order_id")).agg(F.sum("effects").cast("int").alias("ledger_rows"))
    return state.join(outbox, "order_id").join(ledger, "order_id").select(
        "order_id", F.round("amount", 2).alias("amount"), "status", "retry_attempts", "ledger_rows", "outbox_rows")


_RESENT = """(SELECT order_no, order_id, scenario, part, pos, ts, total, 'created' AS st FROM f_log_orders UNION ALL
     SELECT order_no, order_id, scenario, part, pos + 1000000000000, ts + INTERVAL 1 DAY, total, 'updated' FROM f_log_orders WHERE pos % 5 = 0)"""


@query("dedup_delivery_vs_business", """
    SELECT order_id AS key, count(*) AS delivery_effects, count(DISTINCT status) AS business_effects
    FROM (SELECT order_id, status FROM f_log_payments UNION ALL SELECT order_id, status FROM f_log_payments WHERE pos % 5 = 0)
    GROUP BY order_id""", ("f_log_payments",))
def dedup_delivery_vs_business(spark: SparkSession, sf: str) -> DataFrame:
    """Effects per key when deliveries are deduplicated, and when business events (key, status) are.

    An order has a payment and maybe a refund, and every 5th of these events was sent again with a new offset.
    """
    events = D.log_payments(spark, sf).select("key", F.get_json_object("value", "$.status").alias("status"), *V.DELIVERY, "timestamp")
    log = D.resent(events).select("key", "status", *V.DELIVERY)
    once = V.distinct_deliveries(D.deliveries(log), "delivery_seq")
    events = once.groupBy("key", "status").agg(F.count("*").alias("copies"))
    return events.groupBy("key").agg(F.sum("copies").alias("delivery_effects"), F.count("*").alias("business_effects"))


@query("effect_counts", f"""
    SELECT order_id AS key, 'created' AS status, count(*) AS effect_count, min(ts) AS first_processed_at
    FROM {_RESENT} GROUP BY order_id""", ("f_log_orders",))
def effect_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    log = D.resent(D.log_orders(spark, sf).drop("value", "headers"))
    status = F.when(F.col("again"), "updated").otherwise("created")
    kept = V.distinct_deliveries(D.deliveries(log.withColumn("status", status)), "delivery_seq")
    return V.effect_counts(kept, "key", "status", "timestamp", ["partition", "offset"])


@query("business_duplicates", f"""
    SELECT order_id AS key, part AS "partition", count(*) AS copies, min(pos) AS first_offset, max(pos) AS last_offset
    FROM {_RESENT} GROUP BY ALL HAVING count(*) > 1""", ("f_log_orders",))
def business_duplicates_query(spark: SparkSession, sf: str) -> DataFrame:
    return V.business_duplicates(D.resent(D.log_orders(spark, sf))).select(
        "key", "partition", "copies", "first_offset", "last_offset")


@query("latest_by_offset", """
    SELECT order_id, arg_max(status, pos) AS status, round(arg_max(amount, pos) FILTER (WHERE amount IS NOT NULL), 2) AS amount
    FROM f_log_payments GROUP BY order_id""", ("f_log_payments",))
def latest_by_offset_query(spark: SparkSession, sf: str) -> DataFrame:
    return latest_view(spark, sf).withColumn("amount", F.round("amount", 2))


def payment_values(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("key").alias("order_id"), F.get_json_object("value", "$.status").alias("status"),
        F.get_json_object("value", "$.amount").cast("double").alias("amount"), "partition", "offset")


def latest_view(spark: SparkSession, sf: str) -> DataFrame:
    return V.latest_by_offset(payment_values(D.log_payments(spark, sf)), "order_id", ["status", "amount"], ["partition", "offset"])


@query("pull_lookup", """
    SELECT order_id, 'refunded' AS status, round(amount, 2) AS amount FROM f_payments WHERE scenario = 'out-of-stock'""",
       ("f_payments",))
def pull_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Current payment state of the orders that asked for compensation, from the state of the running aggregate."""
    D.log_payments(spark, sf)
    table = LatestTable(spark, scratch_path(spark, "latest"), "order_id", {"status": T.StringType(), "amount": T.DoubleType()})
    table.run(payment_values(D.as_stream(spark, sf, "log-payments", max_files_per_trigger=4)))
    return lookup(table.current(), "order_id", D.compensation(spark, sf)).withColumn("amount", F.round("amount", 2))


@query("payments_state", """
    SELECT order_id, round(arg_min(amount, pos), 2) AS amount, arg_max(st, pos) AS status,
           CAST(sum(attempts) AS BIGINT) AS retry_attempts
    FROM (SELECT l.order_id, l.part, l.pos, p.amount, p.status AS st, p.attempts FROM f_log_orders l JOIN f_payments p USING (order_id)
          UNION ALL
          SELECT l.order_id, l.part, l.pos + 1000000000000, p.amount + 1, 'failed', 1
          FROM f_log_orders l JOIN f_payments p USING (order_id) WHERE l.pos % 5 = 0)
    GROUP BY order_id""", ("f_log_orders", "f_payments"))
def payments_state_query(spark: SparkSession, sf: str) -> DataFrame:
    """Every 5th order is paid again later with another amount and fails."""
    coords = D.log_orders(spark, sf).select(F.col("key").alias("order_id"), "partition", "offset")
    first = D.payments(spark, sf).select("order_id", "amount", "status", "attempts").join(coords, "order_id")
    again = first.filter(F.col("offset") % 5 == 0).select(
        "order_id", (F.col("amount") + 1).alias("amount"), F.lit("failed").alias("status"), F.lit(1).alias("attempts"),
        "partition", (F.col("offset") + 10 ** 12).alias("offset"))
    return V.payments_state(first.unionByName(again), ["partition", "offset"]).withColumn("amount", F.round("amount", 2))


@query("first_write_state", """
    SELECT customer_id, arg_min(order_id, (ts, order_no)) AS order_id, min(ts) AS ts FROM f_orders GROUP BY customer_id""",
       ("f_orders",))
def first_write_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.orders(spark, sf).select("customer_id", "order_id", "ts", "order_no")
    return V.first_write(rows, "customer_id", ["ts", "order_no"]).drop("order_no")


@query("lost_events", """
    SELECT order_id, customer_id FROM f_orders WHERE order_no % 50 = 7""", ("f_orders",))
def lost_events_query(spark: SparkSession, sf: str) -> DataFrame:
    """A store written beside its log without an outbox: some events were never published."""
    store = D.orders(spark, sf).select("order_id", "customer_id")
    log = D.log_orders(spark, sf).filter(D.order_no("key") % 50 != 7).select(F.col("key").alias("order_id"))
    return V.lost_events(store, log, ["order_id"])


def _systems(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Four systems that should know every order; ledger, outbox and sink each lost some."""
    log = D.log_orders(spark, sf).select(F.col("key").alias("order_id"), D.order_no("key").alias("n"))
    return {
        "payments": D.payments(spark, sf).select("order_id"),
        "ledger": log.filter(F.col("n") % 101 != 0).select("order_id"),
        "outbox": log.filter(F.col("n") % 103 != 0).select("order_id"),
        "sink": log.filter(F.col("n") % 51 != 0).select("order_id"),
    }


@query("reconcile_systems", """
    SELECT order_id AS key, CAST(1 AS BIGINT) AS in_payments, CAST(order_no % 101 <> 0 AS BIGINT) AS in_ledger,
           CAST(order_no % 103 <> 0 AS BIGINT) AS in_outbox, CAST(order_no % 51 <> 0 AS BIGINT) AS in_sink,
           concat_ws(',', CASE WHEN order_no % 101 = 0 THEN 'ledger' END, CASE WHEN order_no % 103 = 0 THEN 'outbox' END,
                     CASE WHEN order_no % 51 = 0 THEN 'sink' END) AS missing_in
    FROM f_orders WHERE order_no % 101 = 0 OR order_no % 103 = 0 OR order_no % 51 = 0""", ("f_orders",))
def reconcile_systems(spark: SparkSession, sf: str) -> DataFrame:
    return V.reconcile(_systems(spark, sf), "order_id")


@query("sink_counts", """
    SELECT 'payments' AS system, count(*) AS records FROM f_orders
    UNION ALL SELECT 'ledger', count(*) FROM f_orders WHERE order_no % 101 <> 0
    UNION ALL SELECT 'outbox', count(*) FROM f_orders WHERE order_no % 103 <> 0
    UNION ALL SELECT 'sink', count(*) FROM f_orders WHERE order_no % 51 <> 0""", ("f_orders",))
def sink_counts(spark: SparkSession, sf: str) -> DataFrame:
    return V.system_counts(_systems(spark, sf))


@query("payment_refund_check", """
    SELECT order_id, round(amount, 2) AS amount, status AS payment_status, 'issued' AS refund_status,
           'inventory reservation failed: out of stock' AS reason
    FROM f_payments WHERE scenario = 'out-of-stock'""", ("f_payments",))
def payment_refund_check(spark: SparkSession, sf: str) -> DataFrame:
    refund = D.refunds(spark, sf).select("order_id", F.col("status").alias("refund_status"), "reason")
    return D.payments(spark, sf).select("order_id", F.round("amount", 2).alias("amount"), F.col("status").alias("payment_status")).join(
        refund, "order_id")


@query("batch_stats", """
    SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS total_rows, round(avg(n), 4) AS avg_rows,
           min(n) AS min_rows, max(n) AS max_rows
    FROM (SELECT part, pos // 500 + seq - 1 AS b, count(*) AS n FROM f_deliveries GROUP BY ALL)""", ("f_deliveries",))
def batch_stats_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.with_batch(D.deliveries(D.log_orders(spark, sf)))
    commits = rows.select(F.struct("partition", "batch_id").alias("batch"))
    return V.batch_stats(commits, "batch").withColumn("avg_rows", F.round("avg_rows", 4))


@query("outcome_counts", """
    SELECT part AS "partition", count(*) AS records, count(*) FILTER (WHERE seq = 1) AS applied,
           count(*) FILTER (WHERE seq = 2) AS duplicates, round(count(*) FILTER (WHERE seq = 1) / count(*), 6) AS applied_ratio
    FROM f_deliveries GROUP BY part""", ("f_deliveries",))
def outcome_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = V.delivery_outcomes(D.deliveries(D.log_orders(spark, sf)).select(*V.DELIVERY, "delivery_seq"))
    return V.outcome_counts(outcomes, ["partition"]).withColumn("applied_ratio", F.round("applied_ratio", 6))


@query("read_committed", """
    , data AS (SELECT *, CASE WHEN order_no % 10 <> 0 THEN 'tx-' || order_no % 4 END AS producer FROM f_log_orders),
    tx_log AS (
      SELECT part, producer, pos * 2 AS off, order_id, NULL AS control FROM data
      UNION ALL
      SELECT part, producer, pos * 2 + 1, NULL, CASE WHEN order_no % 7 = 0 THEN 'ABORT' ELSE 'COMMIT' END
      FROM data WHERE order_no % 10 <> 0 AND order_no % 31 <> 0),
    closed AS (SELECT *, first_value(control IGNORE NULLS) OVER (
                 PARTITION BY part, producer ORDER BY off ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS closed_by
               FROM tx_log)
    SELECT part AS "partition", off AS "offset", order_id AS key, producer AS producer_id FROM closed
    WHERE control IS NULL AND (producer IS NULL OR closed_by = 'COMMIT')""", ("f_log_orders",))
def read_committed_query(spark: SparkSession, sf: str) -> DataFrame:
    return V.read_committed(D.transactional(D.log_orders(spark, sf))).select("partition", "offset", "key", "producer_id")


@query("outbox_tail", """
    SELECT id, aggregateid, type, created_at FROM (SELECT id, aggregateid, type, ts AS created_at FROM f_outbox)
    ORDER BY created_at DESC, id DESC LIMIT 5""", ("f_outbox",))
def outbox_tail(spark: SparkSession, sf: str) -> DataFrame:
    """The five newest outbox rows by the time of their commit; rows of one instant by id, which carries no order."""
    return D.published_events(spark, sf).select("id", "aggregateid", "type", "created_at").orderBy(F.desc("created_at"), F.desc("id")).limit(5)


@query("outcomes_by_service", """
    SELECT service, count(*) AS records, count(*) FILTER (WHERE seq = 1) AS applied, count(*) FILTER (WHERE seq = 2) AS duplicates,
           round(count(*) FILTER (WHERE seq = 1) / count(*), 6) AS applied_ratio
    FROM (SELECT 'payment-service' AS service, seq FROM f_deliveries
          UNION ALL SELECT 'inventory-service', 1 FROM f_log_payments
          UNION ALL SELECT 'inventory-service', 2 FROM f_log_payments WHERE pos % 10 = 3) GROUP BY service""", ("f_deliveries", "f_log_payments"))
def outcomes_by_service(spark: SparkSession, sf: str) -> DataFrame:
    """Applied and duplicate deliveries of the two services that consume a topic each."""
    consumers = F.create_map(F.lit("orders"), F.lit("payment-service"), F.lit("payments"), F.lit("inventory-service"))
    log = D.log_orders(spark, sf).select(*V.DELIVERY).unionByName(D.log_payments(spark, sf).select(*V.DELIVERY))
    outcomes = V.delivery_outcomes(D.deliveries(log)).withColumn("service", F.element_at(consumers, F.col("topic")))
    return V.outcome_counts(outcomes, ["service"]).withColumn("applied_ratio", F.round("applied_ratio", 6))
