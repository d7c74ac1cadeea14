"""Event-log sources: Kafka topics, or envelope tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide.schemas import ENVELOPE

# Kafka gives headers as an array of structs with binary values; keys may repeat, the last wins.
_HEADERS = """
    map_from_entries(transform(
        filter(headers, (h, i) -> NOT exists(slice(headers, i + 2, size(headers)), later -> later.key = h.key)),
        h -> struct(h.key, CAST(h.value AS STRING))))"""
_FROM_KAFKA = [
    "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "partition", "offset", "timestamp",
    f"coalesce({_HEADERS}, CAST(map() AS MAP<STRING, STRING>)) AS headers",
]


def from_kafka(records: DataFrame) -> DataFrame:
    """Records as the Kafka source gives them, in the envelope schema."""
    return records.selectExpr(*_FROM_KAFKA)


def kafka_options(servers: str, topics: list[str], starting: str = "earliest", max_per_trigger: int | None = None,
                  min_per_trigger: int | None = None, max_delay: str | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of a topic read. ``starting`` counts only while there is no checkpoint yet."""
    opts = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting,
        "includeHeaders": "true", "maxOffsetsPerTrigger": max_per_trigger, "minOffsetsPerTrigger": min_per_trigger,
        "maxTriggerDelay": max_delay, "minPartitions": min_partitions,
    }
    return {k: str(v) for k, v in opts.items() if v is not None}


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Topics in the envelope schema; needs the Kafka connector on the classpath."""
    reader = spark.readStream if streaming else spark.read
    return from_kafka(reader.format("kafka").options(**options).load())


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None, streaming: bool = False,
             max_files_per_trigger: int | None = None) -> DataFrame:
    """An envelope log table, from its beginning; a stream resumes from its checkpoint.

    Tables written by ``logtide.sinks.log.append_log`` are partitioned by topic, so a topic
    subscription prunes whole folders.
    """
    if streaming:
        reader = spark.readStream.schema(ENVELOPE)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = spark.read.schema(ENVELOPE)
    log = reader.parquet(path).select(*ENVELOPE.fieldNames())
    return log.filter(F.col("topic").isin(topics)) if topics else log
