"""Deterministic business rules: the outcome of a step is encoded in the order id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers in order ids and the texts the services publish.
DECLINED_MARK = "payment-declined"
OUT_OF_STOCK_MARK = "out-of-stock"
PERMANENT_FAIL_MARK = "permanent-fail"
TRANSIENT_FAIL_PATTERN = r"transient-fail-0*(\d+)"
OUT_OF_STOCK_REASON = "inventory reservation failed: out of stock"
DECLINED_OUTCOME = "payment declined, no further steps"
COMPENSATED_OUTCOME = "compensated: payment refunded after inventory failure"
COMPLETED_OUTCOME = "completed"
DEAD_LETTERED_OUTCOME = "payment gave up after all attempts"
REJECTED_TEXT = "downstream rejected %s (attempt %d) — simulated permanent outage"
TIMEOUT_TEXT = "downstream timeout for %s (attempt %d/%d)"
MAX_ATTEMPTS = 3
BASE_BACKOFF_MS = 200


def is_declined(order_id: Column) -> Column:
    return order_id.contains(DECLINED_MARK)


def is_out_of_stock(order_id: Column) -> Column:
    return order_id.contains(OUT_OF_STOCK_MARK)


def never_succeeds(order_id: Column) -> Column:
    return order_id.contains(PERMANENT_FAIL_MARK)


def attempts_needed(order_id: Column) -> Column:
    """First attempt at which the downstream call answers; null when it never does.

    The digits are cast only where there are some and they fit: ``try_cast`` would raise
    and catch an exception for every id without them.
    """
    digits = F.regexp_extract(order_id, TRANSIENT_FAIL_PATTERN, 1)
    return F.when(~never_succeeds(order_id), F.when(F.length(digits).between(1, 9), F.greatest(digits.cast("int"), F.lit(1)))
                  .when(F.length(digits) > 9, F.lit(2 ** 31 - 1)).otherwise(F.lit(1)))


def scenario(order_id: Column) -> Column:
    return (
        F.when(is_declined(order_id), F.lit("payment-declined"))
        .when(is_out_of_stock(order_id), F.lit("out-of-stock"))
        .when(never_succeeds(order_id), F.lit("permanent-fail"))
        .when(order_id.rlike(TRANSIENT_FAIL_PATTERN), F.lit("transient-fail"))
        .otherwise(F.lit("happy"))
    )


def attempt_failure(order_id: Column, attempt: Column) -> Column:
    """Failure text of one downstream attempt, or null when the attempt succeeds."""
    needed = attempts_needed(order_id)
    return (
        F.when(never_succeeds(order_id), F.format_string(REJECTED_TEXT, order_id, attempt))
        .when(attempt < needed, F.format_string(TIMEOUT_TEXT, order_id, attempt, needed))
    )


def tracking_id(order_id: Column, at: Column) -> Column:
    """``TRK-<order>-<epoch ms>`` from event time, so a replay gives the same id."""
    return F.concat_ws("-", F.lit("TRK"), order_id, F.unix_millis(at).cast("string"))


def iso_instant(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
