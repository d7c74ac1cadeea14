"""Bounded retry without sleeping: the attempts of a record are computed, not waited for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logtide.functions import rules as R
from logtide.operators.decode import computed_once


def retry_plan(df: DataFrame, failure, max_attempts: int = R.MAX_ATTEMPTS,
               base_ms: int = R.BASE_BACKOFF_MS, key: str = "order_id") -> DataFrame:
    """One row per attempt made: attempt, outcome, failure reason, time waited before it.

    ``failure`` is (key Column, attempt Column) -> failure text or null. Attempts after the
    first success are not made. Attempt k waits base * 2^(k-2) after attempt k-1 failed.
    """
    failures = computed_once(df, _failures=F.array(*[failure(F.col(key), F.lit(k)) for k in range(1, max_attempts + 1)]))
    made = F.lit(max_attempts)
    for k in range(max_attempts - 1, 0, -1):
        made = F.when(F.col("_failures")[k - 1].isNull(), k).otherwise(made)
    exploded = failures.select(*df.columns, F.posexplode(F.slice("_failures", 1, made)).alias("_pos", "failure_reason"))
    rows = exploded.withColumn("attempt", F.col("_pos") + 1)
    k = F.col("attempt")
    return rows.select(
        *df.columns, "attempt",
        F.when(F.col("failure_reason").isNull(), "success")
        .when(k < max_attempts, "retry").otherwise("exhausted").alias("outcome"),
        "failure_reason",
        F.when(k == 1, 0).otherwise(F.lit(base_ms) * F.expr("shiftleft(1, greatest(attempt - 2, 0))"))
        .cast("bigint").alias("backoff_ms"),
        (F.lit(base_ms) * (F.expr("shiftleft(1, attempt - 1)") - 1)).cast("bigint").alias("waited_ms"),
    )


def with_final_outcome(df: DataFrame, key: str = "order_id", max_attempts: int = R.MAX_ATTEMPTS) -> DataFrame:
    """Add ``attempts`` and ``exhausted``: the retry loop in closed form for the id-encoded rule."""
    needed = computed_once(df, _needed=R.attempts_needed(F.col(key)))
    exhausted = F.col("_needed").isNull() | (F.col("_needed") > max_attempts)
    return needed.select(
        *df.columns, F.when(exhausted, F.lit(max_attempts)).otherwise(F.col("_needed")).alias("attempts"),
        exhausted.alias("exhausted"))


def message_outcomes(orders: DataFrame, max_attempts: int = R.MAX_ATTEMPTS) -> DataFrame:
    """Counter label per message at its end: success (first try), retry, or exhausted."""
    return with_final_outcome(orders.select("order_id"), max_attempts=max_attempts).select(
        "order_id", "attempts",
        F.when(F.col("exhausted"), "exhausted").when(F.col("attempts") == 1, "success").otherwise("retry").alias("outcome"))


def dead_letters(log: DataFrame, order_id: str = "key", max_attempts: int = R.MAX_ATTEMPTS) -> DataFrame:
    """Dead-letter records with full context, one per exhausted delivery.

    Declined orders are answers, not failures, and never come here.
    """
    oid = F.col(order_id)
    called = with_final_outcome(log.filter(~R.is_declined(oid)), order_id, max_attempts)
    return called.filter("exhausted").select(
        F.col("topic").alias("original_topic"), F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"), oid.alias("order_id"), F.col("value").alias("order"),
        R.attempt_failure(oid, F.lit(max_attempts)).alias("failure_reason"), "attempts",
        F.col("timestamp").alias("failed_at"))


def dead_letter_log(letters: DataFrame, topic: str = "payments-dlq") -> DataFrame:
    """Dead letters as keyed JSON records; the order stays a nested JSON object."""
    order = F.from_json("order", "struct<orderId:string,customerId:string,"
                                 "items:array<struct<sku:string,qty:int>>,total:double,status:string>")
    body = F.to_json(F.struct(
        F.col("original_topic").alias("originalTopic"), F.col("original_partition").alias("originalPartition"),
        F.col("original_offset").cast("string").alias("originalOffset"), order.alias("order"),
        F.col("failure_reason").alias("failureReason"), "attempts",
        R.iso_instant(F.col("failed_at")).alias("failedAt")))
    return letters.select(F.lit(topic).alias("topic"), F.col("order_id").alias("key"), body.alias("value"))
