"""Queries over lag, counters, alerts, traces and claim checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.operators import observe as O
from logtide.operators.ordered import trailing_sum
from logtide.operators.claims import redeem
from logtide.operators.traces import trace_tree
from logtide.plans import derived as D
from logtide.plans.registry import query


@query("consumer_lag", """
    SELECT consumer_group, part AS "partition", committed, log_end, log_end - committed AS lag FROM f_offsets""",
       ("f_offsets",))
def consumer_lag_query(spark: SparkSession, sf: str) -> DataFrame:
    log = D.log_orders(spark, sf)
    return O.consumer_lag(log, D.group_offsets(log)).drop("topic")


@query("group_lag", """
    SELECT consumer_group, CAST(sum(log_end - committed) AS BIGINT) AS lag FROM f_offsets GROUP BY consumer_group""",
       ("f_offsets",))
def group_lag_query(spark: SparkSession, sf: str) -> DataFrame:
    log = D.log_orders(spark, sf)
    return O.group_lag(O.consumer_lag(log, D.group_offsets(log)))


SERIES = ["name", "event_type"]


@query("counter_rate", """
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, round(sum(delta) / 3600, 8) AS rate
    FROM f_deltas GROUP BY ALL""", ("f_deltas",))
def counter_rate_query(spark: SparkSession, sf: str) -> DataFrame:
    return O.counter_rate(D.metrics(spark, sf), SERIES, 3600, ["event_type"]).withColumn("rate", F.round("rate", 8))


@query("service_rates", """
    , hourly AS (SELECT CASE scenario WHEN 'permanent-fail' THEN 'dlq_messages_total' ELSE 'compensations_total' END AS name,
                        CAST(floor(epoch(paid_at) / 3600) AS BIGINT) AS hour, count(*) AS n
                 FROM f_payments WHERE scenario IN ('permanent-fail', 'out-of-stock') GROUP BY ALL),
    samples AS (SELECT name, hour, sum(n) OVER (PARTITION BY name, hour // 24 ORDER BY hour) AS value FROM hourly),
    deltas AS (SELECT *, lag(value) OVER (PARTITION BY name ORDER BY hour) AS before FROM samples)
    SELECT name, 'payment-service' AS service, make_timestamp(hour // 24 * 86400000000) AS window_start,
           round(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) / 86400, 8) AS rate
    FROM deltas GROUP BY ALL""", ("f_payments",))
def service_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rates of dead letters and compensations by service."""
    keys = ["name", "service"]
    return O.counter_rate(D.service_counters(spark, sf), keys, 86_400, keys).withColumn("rate", F.round("rate", 8))


@query("counter_increase", "SELECT event_type, ts, value, increase FROM f_increase", ("f_increase",))
def counter_increase_query(spark: SparkSession, sf: str) -> DataFrame:
    return O.counter_increase(D.metrics(spark, sf), SERIES, 300).select("event_type", "ts", "value", "increase")


@query("alert_states", """
    , marked AS (SELECT *, increase > 1 AS hot,
                 max(CASE WHEN NOT increase > 1 THEN ts END) OVER (PARTITION BY event_type ORDER BY ts) AS last_off FROM f_increase),
    streaks AS (SELECT *, min(CASE WHEN hot THEN ts END) OVER (PARTITION BY event_type, last_off) AS since FROM marked)
    SELECT event_type, ts, CASE WHEN NOT hot THEN 'inactive' WHEN ts - since >= INTERVAL 120 SECONDS THEN 'firing'
                                ELSE 'pending' END AS state
    FROM streaks""", ("f_increase",))
def alert_states_query(spark: SparkSession, sf: str) -> DataFrame:
    grown = O.counter_increase(D.metrics(spark, sf), SERIES, 300)
    return O.alert_states(grown, SERIES, F.col("increase") > 1, 120).select("event_type", "ts", "state")


@query("lag_alert", """
    , daily AS (SELECT part, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM f_log_orders GROUP BY ALL),
    samples AS (SELECT part, day, sum(n) OVER (PARTITION BY part ORDER BY day RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) AS lag FROM daily),
    marked AS (SELECT *, lag > 5 AS hot, max(CASE WHEN NOT lag > 5 THEN day END) OVER (PARTITION BY part ORDER BY day) AS last_off FROM samples),
    streaks AS (SELECT *, min(CASE WHEN hot THEN day END) OVER (PARTITION BY part, last_off) AS since FROM marked)
    SELECT 'payment-service' AS consumer_group, part AS "partition", day AS ts, CAST(lag AS BIGINT) AS lag,
           CASE WHEN NOT hot THEN 'inactive' WHEN day - since >= INTERVAL 1 DAY THEN 'firing' ELSE 'pending' END AS state
    FROM streaks""", ("f_log_orders",))
def lag_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Lag of a group that is always three days behind, sampled daily: an alert once it was above 5 for a day."""
    days = D.log_orders(spark, sf).groupBy("partition", F.date_trunc("day", "timestamp").alias("ts")).agg(F.count("*").alias("n"))
    behind = trailing_sum(days, ["partition"], "ts", "n", 3 * 86_400, "lag", block_seconds=30 * 86_400)
    return O.alert_states(behind, ["partition"], F.col("lag") > 5, 86_400).select(F.lit("payment-service").alias("consumer_group"), "partition", "ts", "lag", "state")


_TREE = """
    SELECT s.trace_id, s.span_id, s.name, split_part(s.name, '.', 1) || '-service' AS service,
           split_part(p.name, '.', 1) || '-service' AS parent_service,
           CASE WHEN s.parent_span_id IS NULL THEN 'root' WHEN p.span_id IS NULL THEN 'broken' ELSE 'child' END AS link,
           CAST(s.hop - CASE WHEN s.order_no % 200 = 0 THEN 1 ELSE 0 END AS BIGINT) AS depth,
           CAST(epoch_ms(s.start_at) - epoch_ms(p.start_at + INTERVAL 1 SECOND) AS DOUBLE) AS gap_ms
    FROM f_all_spans s LEFT JOIN f_all_spans p ON p.trace_id = s.trace_id AND p.span_id = s.parent_span_id"""


@query("trace_tree", _TREE, ("f_all_spans",))
@query("trace_tree_all", _TREE, ("f_all_spans",))
def trace_tree_query(spark: SparkSession, sf: str) -> DataFrame:
    """The traces of all orders, by the hops that each reached."""
    return trace_tree(D.all_spans(spark, sf)).select(
        "trace_id", "span_id", "name", "service", "parent_service", "link", "depth", F.col("gap_ms").cast("double").alias("gap_ms"))


@query("claim_check_verify", """
    SELECT event_id, key, CASE WHEN doc_id % 70 = 0 THEN 'MISSING' WHEN checksum = true_sha THEN 'OK' ELSE 'MISMATCH' END AS status
    FROM f_refs""", ("f_refs",))
def claim_check_verify(spark: SparkSession, sf: str) -> DataFrame:
    return redeem(D.attachment_refs(spark, sf), D.blobs(spark, sf)).select("event_id", "key", "status")
