"""Read committed on a stream: records wait in state for the control record of their transaction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
HELD = T.StructType([T.StructField("offset", T.LongType()), T.StructField("record", T.StringType())])
RELEASED = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("producer_id", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("record", T.StringType()), T.StructField("verdict", T.StringType())])


class OpenTransactions(StatefulProcessor):
    """Per (topic, partition, producer): the records since its last control record.

    COMMIT releases them, ABORT drops them. A transaction that stays open ``timeout_ms`` of event time behind its newest
    record is shown: its records come out with the verdict ``open``, and go on waiting for their control record, which
    still decides. Batches must come in log order; inside a batch any order will do.
    """

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", HELD)
        self.alarm = handle.getValueState("alarm", "at LONG")

    def _out(self, key, rows: list[tuple], verdict: str) -> pd.DataFrame:
        return pd.DataFrame({"topic": [key[0]] * len(rows), "partition": [key[1]] * len(rows), "producer_id": [key[2]] * len(rows),
                             "offset": [r[0] for r in rows], "record": [r[1] for r in rows], "verdict": [verdict] * len(rows)})

    def _set_alarm(self, at: int | None) -> None:
        if self.alarm.exists():
            self.handle.deleteTimer(self.alarm.get()[0])
            self.alarm.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.alarm.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunks = pd.concat(list(rows)).sort_values("offset")
        newest = int(chunks["event_ms"].max())
        marks = chunks[chunks["control"].notna()]
        waiting = [tuple(r) for r in self.held.get()] if self.held.exists() else []
        at = 0
        data = list(zip(chunks["offset"], chunks["record"], chunks["control"].notna(), strict=True))
        for mark, verdict in zip(marks["offset"], marks["control"], strict=True):
            while at < len(data) and data[at][0] <= mark:
                if not data[at][2]:
                    waiting.append((int(data[at][0]), data[at][1]))
                at += 1
            if verdict == "COMMIT" and waiting:
                yield self._out(key, waiting, "committed")
            waiting = []
        waiting += [(int(o), r) for o, r, is_mark in data[at:] if not is_mark]
        if waiting:
            self.held.put(waiting)
        else:
            self.held.clear()
        self._set_alarm(newest + self.timeout_ms if waiting else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.clear()
        if self.held.exists():
            yield self._out(key, [tuple(r) for r in self.held.get()], "open")

    def close(self) -> None:
        pass


def committed_stream(log: DataFrame, timeout_ms: int, watermark: str = "1 minute", at: str = "timestamp", producer: str = "producer_id",
                     control: str = "control") -> DataFrame:
    """The stream form of ``read_committed``: columns of ``log`` and ``verdict``.

    ``committed``: data outside transactions at once, data of a transaction when its COMMIT comes. ``open``: data of a
    transaction without control record, ``timeout_ms`` of event time behind its newest record, once; it is not released.
    State is what is open now; a record's other columns wait in it as JSON.
    """
    rest = [c for c in log.columns if c not in ("topic", "partition", producer, "offset", control)]
    schema = T.StructType([f for f in log.schema.fields if f.name in rest])
    known = log.withWatermark(at, watermark)
    plain = known.where(F.col(producer).isNull() & F.col(control).isNull()).select(*log.columns, F.lit("committed").alias("verdict"))
    keyed = known.where(F.col(producer).isNotNull()).select(
        "topic", "partition", F.col(producer).alias("producer_id"), "offset", F.to_json(F.struct(*rest), _TIMES).alias("record"), F.col(control).alias("control"),
        F.unix_millis(at).alias("event_ms"), at)
    released = keyed.groupBy("topic", "partition", "producer_id").transformWithStateInPandas(
        OpenTransactions(timeout_ms), RELEASED, "Append", "eventTime")
    row = released.withColumn("_r", F.from_json("record", schema, _TIMES))
    columns = {"topic": F.col("topic"), "partition": F.col("partition"), producer: F.col("producer_id"), "offset": F.col("offset"), control: F.lit(None).cast("string"),
               **{c: F.col("_r").getField(c) for c in rest}}
    return plain.unionByName(row.select(*[columns[c].alias(c) for c in log.columns], "verdict"))
