"""Retry of a stream without blocking it: failed attempts wait in state, not in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ATTEMPT = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("attempt", T.IntegerType()),
    T.StructField("outcome", T.StringType()), T.StructField("failure_reason", T.StringType()),
    T.StructField("at", T.TimestampType()),
])


class RetryProcessor(StatefulProcessor):
    """Calls ``attempt(order_id, k) -> failure text or None``; a failure re-runs after its backoff.

    The wait is an event-time timer at ``first event time + backoff``, so a replay makes the
    same attempts at the same times. Deliveries of an order that is already waiting or done
    are ignored; finished orders are forgotten after ``remember_ms``.
    """

    def __init__(self, attempt: Callable[[str, int], str | None], max_attempts: int, base_ms: int, remember_ms: int):
        self.attempt, self.max_attempts, self.base_ms, self.remember_ms = attempt, max_attempts, base_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # (attempts made, finished)
        self.progress = handle.getValueState("progress", "made INT, finished BOOLEAN")

    def _run(self, order_id: str, made: int, at_ms: int) -> pd.DataFrame:
        k = made + 1
        reason = self.attempt(order_id, k)
        outcome = "success" if reason is None else "retry" if k < self.max_attempts else "exhausted"
        wait = self.base_ms * 2 ** (k - 1) if outcome == "retry" else self.remember_ms
        self.progress.update((k, outcome != "retry"))
        self.handle.registerTimer(at_ms + wait)
        return pd.DataFrame({"order_id": [order_id], "attempt": [k], "outcome": [outcome], "failure_reason": [reason],
                             "at": [pd.Timestamp(at_ms, unit="ms")]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = min(int(chunk["event_ms"].min()) for chunk in rows)
        if not self.progress.exists():
            yield self._run(key[0], 0, first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        made, finished = self.progress.get()
        if finished:
            self.progress.clear()
        else:
            yield self._run(key[0], made, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def retry_stream(orders: DataFrame, attempt: Callable[[str, int], str | None], watermark: str = "1 minute",
                 max_attempts: int = 3, base_ms: int = 200, remember_ms: int = 3_600_000) -> DataFrame:
    """Attempts of a stream of (order_id, ts); needs the RocksDB state store provider."""
    keyed = orders.withWatermark("ts", watermark).select(
        "order_id", "ts", F.unix_millis("ts").alias("event_ms"))
    return keyed.groupBy("order_id").transformWithStateInPandas(
        statefulProcessor=RetryProcessor(attempt, max_attempts, base_ms, remember_ms),
        outputStructType=ATTEMPT, outputMode="append", timeMode="eventTime")
