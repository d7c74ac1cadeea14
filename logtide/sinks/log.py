"""Publishing to event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtide.functions.hashing import partition_for
from logtide.operators.ordered import chunked_positions
from logtide.schemas import ENVELOPE


def to_log(df: DataFrame, key: Column, topic: Column, value: Column, at: Column,
           headers: Column | None = None) -> DataFrame:
    """Keyed records (key, value, topic, timestamp, headers) without coordinates yet."""
    none = F.create_map().cast("map<string,string>")
    return df.select(key.cast("string").alias("key"), value.alias("value"), topic.alias("topic"),
                     at.alias("timestamp"), (none if headers is None else headers).alias("headers"))


def place(records: DataFrame, partitions: int, order: list[str], partitioner=partition_for) -> DataFrame:
    """Give records their partition by key and strictly increasing offsets in ``order``.

    ``order`` has to be unique per partition. Numbering works by chunks of the order, so a partition that holds most of the
    topic is still numbered by many tasks, and the records move once: what is stored afterwards is the only write.
    """
    placed = records.withColumn("partition", partitioner(F.col("key"), partitions))
    return chunked_positions(placed, ["topic", "partition"], order, "offset").select(*ENVELOPE.fieldNames())


def append_log(log: DataFrame, path: str) -> None:
    """Append envelope rows to a log table, one folder per topic."""
    log.select(*ENVELOPE.fieldNames()).write.mode("append").option("compression", "zstd").partitionBy("topic").parquet(path)


def kafka_rows(log: DataFrame) -> DataFrame:
    """The columns the Kafka sink takes; the topic column routes each row."""
    headers = F.transform(F.map_entries("headers"), lambda h: F.struct(
        h["key"].alias("key"), h["value"].cast("binary").alias("value")))
    return log.select("key", "value", "topic", headers.alias("headers"))
