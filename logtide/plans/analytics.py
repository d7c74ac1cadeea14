"""Queries over joins, aggregates and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.functions import rules as R
from logtide.functions.hashing import murmur2, placement
from logtide.operators.joins import interval_join
from logtide.operators.observe import share_of_total, throughput
from logtide.operators.partitions import (
    copartition_report, hot_keys, partition_distribution, salt_sweep, salted_sum,
)
from logtide.operators.sketches import hot_keys_sketched, key_sketches
from logtide.plans import derived as D
from logtide.plans.oracle import partition as partition_sql
from logtide.plans.registry import query
from logtide.session import written
from logtide.sources.tables import table
from logtide.streaming.jobs import tumbling_totals

HOUR_MS = 3_600_000


def is_vip():
    return F.col("key") == "customer-VIP"


def _joined(spark: SparkSession, sf: str, before: int, after: int) -> DataFrame:
    orders = D.orders(spark, sf).select("order_id", "customer_id", F.col("total").alias("order_total"), "ts")
    paid = D.payments(spark, sf).select("order_id", F.col("status").alias("payment_status"), F.col("processed_at").alias("paid_at"))
    pairs = interval_join(orders, paid, ["order_id"], "ts", "paid_at", before, after)
    return pairs.select("order_id", "customer_id", F.round("order_total", 2).alias("order_total"), "payment_status",
                        R.iso_instant(F.col("paid_at")).alias("payment_processed_at"))


_JOIN_SQL = """
    SELECT o.order_id, o.customer_id, round(o.total, 2) AS order_total, p.status AS payment_status,
           strftime(p.paid_at, '%Y-%m-%dT%H:%M:%S.000Z') AS payment_processed_at
    FROM f_orders o JOIN f_payments p ON o.order_id = p.order_id
     AND p.paid_at BETWEEN o.ts - INTERVAL {0} AND o.ts + INTERVAL {0}"""


@query("interval_join_1h", _JOIN_SQL.format("1 HOUR"), ("f_payments",))
def interval_join_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, HOUR_MS, HOUR_MS)


@query("interval_join_5d", _JOIN_SQL.format("5 DAYS"), ("f_payments",))
def interval_join_5d(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf, 120 * HOUR_MS, 120 * HOUR_MS)


@query("click_session_join", """
    SELECT CAST(c.user_id AS VARCHAR) AS user_id, c.props AS page, 'd' || s.event_id % 3 AS device,
           c.ts AS click_ts, s.ts AS session_ts
    FROM events c JOIN events s ON c.user_id = s.user_id AND c.event_type = 'click' AND s.event_type = 'signup'
     AND s.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 1 HOUR""")
def click_session_join(spark: SparkSession, sf: str) -> DataFrame:
    return interval_join(D.clicks(spark, sf), D.sessions(spark, sf), ["user_id"], "click_ts", "session_ts",
                         HOUR_MS, HOUR_MS).select("user_id", "page", "device", "click_ts", "session_ts")


@query("copartition_report", f"""
    WITH placed AS (SELECT key, {partition_sql('key', 3)} AS l, {partition_sql('key', 5)} AS r
                    FROM (SELECT DISTINCT 'user-' || user_id AS key FROM events))
    SELECT max(l) + 1 AS left_partitions, max(r) + 1 AS right_partitions, count(*) AS shared_keys,
           count(*) FILTER (WHERE l <> r) AS misplaced_keys, 'different partition counts' AS verdict
    FROM placed""")
def copartition_query(spark: SparkSession, sf: str) -> DataFrame:
    """Users placed on 3 partitions by one topic and on 5 by another."""
    keyed = table(spark, sf, "events").select(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("key"))
    hashed = keyed.groupBy("key").count().withColumn("h", murmur2(F.col("key")))
    return copartition_report(hashed.select("key", placement(F.col("h"), 3).alias("partition")),
                              hashed.select("key", placement(F.col("h"), 5).alias("partition")))


@query("payments_per_minute", """
    SELECT date_trunc('minute', paid_at) AS window_start, status, count(*) AS payment_count,
           round(sum(amount), 2) AS total_amount
    FROM f_payments GROUP BY ALL""", ("f_payments",))
def payments_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling_totals(D.payments(spark, sf), "processed_at").withColumn("total_amount", F.round("total_amount", 2))


@query("revenue_by_category", """
    SELECT category, round(sum(amount), 2) AS revenue FROM f_events GROUP BY category""", ("f_events",))
def revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return D.analytics_events(spark, sf).groupBy("category").agg(F.round(F.sum("amount"), 2).alias("revenue"))


@query("event_type_share", """
    SELECT event_type, count(*) AS records, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM f_events GROUP BY event_type""", ("f_events",))
def event_type_share(spark: SparkSession, sf: str) -> DataFrame:
    return share_of_total(D.analytics_events(spark, sf), "event_type").withColumn("share", F.round("share", 6))


@query("daily_trend", """
    SELECT strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS day, count(*) AS records, round(sum(amount), 2) AS revenue
    FROM f_events GROUP BY ALL""", ("f_events",))
def daily_trend(spark: SparkSession, sf: str) -> DataFrame:
    return D.analytics_events(spark, sf).groupBy(F.to_date(F.timestamp_millis("event_time")).alias("day")).agg(
        F.count("*").alias("records"), F.round(F.sum("amount"), 2).alias("revenue")).withColumn("day", F.col("day").cast("string"))


@query("top_products", """
    SELECT product_id, round(sum(amount), 2) AS revenue FROM f_events
    GROUP BY product_id ORDER BY round(sum(amount), 2) DESC, product_id LIMIT 10""", ("f_events",))
def top_products(spark: SparkSession, sf: str) -> DataFrame:
    return D.analytics_events(spark, sf).groupBy("product_id").agg(F.round(F.sum("amount"), 2).alias("revenue")).orderBy(
        F.desc("revenue"), "product_id").limit(10)


@query("status_totals", """
    SELECT status, count(*) AS records, round(sum(amount), 2) AS amount FROM f_payments
    WHERE order_id LIKE 'order-transient-fail-%' OR order_id LIKE 'order-p%' GROUP BY status""", ("f_payments",))
def status_totals(spark: SparkSession, sf: str) -> DataFrame:
    oid = F.col("order_id")
    return D.payments(spark, sf).filter(oid.like("order-transient-fail-%") | oid.like("order-p%")).groupBy("status").agg(
        F.count("*").alias("records"), F.round(F.sum("amount"), 2).alias("amount"))


@query("partition_distribution", """
    , total AS (SELECT count(*) AS n FROM f_skewed_placed),
    loads AS (SELECT p AS "partition", count(s.part) AS records
              FROM (SELECT unnest(range(6)) AS p) x LEFT JOIN f_skewed_placed s ON s.part = x.p GROUP BY p)
    SELECT "partition", records, round(records / total.n, 6) AS share, records / total.n > 0.2 AS over_healthy,
           row_number() OVER (ORDER BY records DESC, "partition") = 1 AS is_worst
    FROM loads, total""", ("f_skewed_placed",))
def partition_distribution_query(spark: SparkSession, sf: str) -> DataFrame:
    keys = D.skewed(spark, sf).groupBy("key").agg(F.count("*").alias("n"))
    placed = keys.select(placement(murmur2(F.col("key")), 6).alias("partition"), "n")
    return partition_distribution(placed, 6, records="n").withColumn("share", F.round("share", 6))


@query("hot_keys", """
    SELECT key, count(*) AS records, round(count(*) / (SELECT count(*) FROM f_skewed), 6) AS share
    FROM f_skewed GROUP BY key HAVING count(*) / (SELECT count(*) FROM f_skewed) > 0.0015""", ("f_skewed",))
def hot_keys_query(spark: SparkSession, sf: str) -> DataFrame:
    return hot_keys(D.skewed(spark, sf), "key", 0.0015).withColumn("share", F.round("share", 6))


@query("hot_keys_by_day", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, key, count(*) AS records,
           round(count(*) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)), 6) AS share
    FROM f_skewed GROUP BY date_trunc('day', ts), key
    QUALIFY count(*) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)) > 0.01""", ("f_skewed",))
def hot_keys_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return hot_keys(D.skewed(spark, sf), "key", 0.01, F.date_trunc("day", "ts")).withColumn("share", F.round("share", 6))


def _daily_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """One stored sketch a day, as a job would add it to the table each night."""
    return written(key_sketches(D.skewed(spark, sf), "key", F.date_trunc("day", "ts")), "key-sketches")


@query("hot_keys_sketched", """
    SELECT key, count(*) AS records, round(count(*) / (SELECT count(*) FROM f_skewed), 6) AS share
    FROM f_skewed GROUP BY key HAVING count(*) / (SELECT count(*) FROM f_skewed) > 0.0015""", ("f_skewed",))
def hot_keys_sketched_query(spark: SparkSession, sf: str) -> DataFrame:
    """``hot_keys`` from the days' sketches and an exact count of the candidates alone."""
    found = hot_keys_sketched(D.skewed(spark, sf), "key", _daily_sketches(spark, sf), 0.0015)
    return found.withColumn("share", F.round("share", 6))


@query("hot_keys_sketched_by_day", """
    SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, key, count(*) AS records,
           round(count(*) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)), 6) AS share
    FROM f_skewed GROUP BY date_trunc('day', ts), key
    QUALIFY count(*) / sum(count(*)) OVER (PARTITION BY date_trunc('day', ts)) > 0.01""", ("f_skewed",))
def hot_keys_sketched_by_day(spark: SparkSession, sf: str) -> DataFrame:
    found = hot_keys_sketched(D.skewed(spark, sf), "key", _daily_sketches(spark, sf), 0.01, window=F.date_trunc("day", "ts"))
    return found.withColumn("share", F.round("share", 6))


@query("salt_sweep", f"""
    , plans AS (SELECT salt_buckets, partitions FROM (SELECT unnest([0, 4, 8, 16, 32, 64]) AS salt_buckets),
                       (SELECT unnest([6, 12, 24]) AS partitions)),
    counted AS (SELECT b AS salt_buckets, CASE WHEN key = 'customer-VIP' AND b > 0 THEN key || '#' || event_id % greatest(b, 1)
                       ELSE key END AS placed_key, count(*) AS n
                FROM f_skewed, (SELECT unnest([0, 4, 8, 16, 32, 64]) AS b) GROUP BY ALL),
    hashed AS (SELECT placed_key, {partition_sql('placed_key', 24)} AS p24 FROM (SELECT DISTINCT placed_key FROM counted)),
    loads AS (SELECT partitions, c.salt_buckets, p24 % partitions AS p, sum(n) AS load
              FROM counted c JOIN hashed USING (placed_key) JOIN plans USING (salt_buckets) GROUP BY ALL)
    SELECT CAST(partitions AS INTEGER) AS partitions, CAST(salt_buckets AS INTEGER) AS salt_buckets,
           round(max(load) / sum(load), 6) AS worst_share
    FROM loads GROUP BY ALL""", ("f_skewed",))
def salt_sweep_query(spark: SparkSession, sf: str) -> DataFrame:
    return salt_sweep(D.skewed(spark, sf), "key", "event_id", is_vip(), [6, 12, 24], [0, 4, 8, 16, 32, 64]).withColumn(
        "worst_share", F.round("worst_share", 6))


@query("salted_sum", """
    SELECT key, round(sum(value), 2) AS total, count(*) AS records FROM f_skewed GROUP BY key""", ("f_skewed",))
def salted_sum_query(spark: SparkSession, sf: str) -> DataFrame:
    return salted_sum(D.skewed(spark, sf), "key", "value", is_vip(), 16, "event_id").withColumn("total", F.round("total", 2))


@query("throughput_summary", """
    SELECT event_type, count(*) AS messages, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
           greatest(epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000, 1) / CAST(1000 AS DOUBLE) AS elapsed_seconds,
           round(count(*) / (greatest(epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000, 1) / 1000.0), 6) AS messages_per_second,
           round(sum(strlen(props)) / count(*), 4) AS avg_bytes
    FROM events GROUP BY event_type""")
def throughput_summary(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select("event_type", F.col("ts").alias("timestamp"), F.col("props").alias("value"))
    return throughput(log, ["event_type"]).select(
        "event_type", "messages", "bytes", F.col("elapsed_seconds").cast("double").alias("elapsed_seconds"),
        F.round("messages_per_second", 6).cast("double").alias("messages_per_second"), F.round("avg_bytes", 4).alias("avg_bytes"))
