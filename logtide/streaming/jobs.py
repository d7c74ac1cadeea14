"""Streaming jobs: landing, typed ingestion, hops, windows, latest values, relay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from logtide.operators.delivery import relay
from logtide.streaming.commits import CommitStore


def drain(stream: DataFrame, sink, checkpoint: str, mode: str = "append", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Run a stream over all data that is there now, in rate-limited batches, then stop.

    ``sink`` is a Parquet path, with folders by ``partition_by``, or a ``foreachBatch`` function.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        query = writer.foreachBatch(sink).start()
    else:
        query = writer.partitionBy(*partition_by).format("parquet").option("path", sink).start()
    query.awaitTermination()
    return query


def follow(stream: DataFrame, sink, checkpoint: str, every: str = "10 seconds", mode: str = "append",
           name: str | None = None) -> StreamingQuery:
    """Run a stream until it is stopped, one batch per interval."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    if name:
        writer = writer.queryName(name)
    return (writer.foreachBatch(sink) if callable(sink) else writer.format("parquet").option("path", sink)).start()


class LimitedPush:
    """Rows of a push query up to a LIMIT, with the number still to emit in the commit marker's place, not in the driver.

    Each batch writes its share of the limit, and the total so far, under its id; a retry after a crash overwrites its own
    share, and a restarted query goes on from the total of the last committed batch. ``order`` decides which rows of a batch
    are taken when not all are, so that a retry takes the same ones; it needs to be unique for that.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, limit: int, order: list[str], crash=None):
        self.limit, self.order, self.crash = limit, order, crash
        total = T.StructType([T.StructField("emitted", T.LongType())])
        self.store = CommitStore(spark, root, {"rows": schema, "total": total})

    def emitted(self, before: int | None = None) -> int:
        """Rows emitted by committed batches, from the newest of them alone; of those before a batch if it is given."""
        if before:
            last = self.store.of_batches("total", [before - 1]).first()
            if last is not None and self.store.is_committed(before - 1):
                return last.emitted
        return self.store.committed("total", before).agg(F.max("emitted")).first()[0] or 0

    def emit(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` function. Every batch is computed whole, as stateful streams require, and cut when it is written."""
        if self.store.is_committed(batch_id):
            return
        done = self.emitted(batch_id)
        share = batch.orderBy(*self.order).limit(max(0, self.limit - done))
        self.store._write(share, "rows", batch_id)
        written = self.store.of_batches("rows", [batch_id]).count()
        if self.crash:
            self.crash("before-marker")
        spark = batch.sparkSession
        self.store.commit(batch_id, {"total": spark.range(1).select(F.lit(done + written).cast("long").alias("emitted")).coalesce(1)})
        if self.crash:
            self.crash("after-marker")

    def rows(self) -> DataFrame:
        return self.store.committed("rows").drop("batch_id")


def push(stream: DataFrame, limit: int, path: str, checkpoint: str, order: list[str], every: str = "1 second", crash=None) -> DataFrame:
    """Push query with a LIMIT: emit results as they come and stop once ``limit`` rows are out, over restarts too."""
    out = LimitedPush(stream.sparkSession, path, stream.schema, limit, order, crash)
    if out.emitted() < limit:
        query = follow(stream, out.emit, checkpoint, every)
        try:
            while not query.awaitTermination(1) and out.emitted() < limit:
                pass
        finally:
            query.stop()
    return out.rows()


def typed_events(events: DataFrame) -> DataFrame:
    """The typed columns of the analytics table from raw events with an epoch-ms time."""
    at = F.timestamp_millis("event_time")
    return events.select(
        "event_id", "event_type", at.alias("event_time"), F.to_date(at).alias("event_date"),
        "user_id", "product_id", "category", "country", "amount")


def ingest_events(spark: SparkSession, source: str, schema: T.StructType, root: str, max_files_per_trigger: int = 100,
                  files_per_date: int = 4) -> DataFrame:
    """Continuous ingestion of an events folder into a typed table with a folder per date, in bounded batches; returns the table.

    A batch writes at most ``files_per_date`` files a date: rows are dealt by date and a part of it, so that neither a date
    that has most of a batch becomes one task nor every task writes to every date.
    """
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    purchase = F.col("event_type") == "purchase"
    shaped = raw.select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
        F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type")).alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("prod-"), (F.col("event_id") % 200).cast("string")).alias("product_id"),
        F.concat(F.lit("cat-"), (F.col("event_id") % 6).cast("string")).alias("category"),
        F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("country"),
        F.when(purchase, F.col("value")).otherwise(F.lit(0.0)).alias("amount"))
    table = typed_events(shaped).repartition("event_date", F.pmod(F.xxhash64("event_id"), F.lit(files_per_date)))
    drain(table, f"{root}/table", f"{root}/checkpoint", partition_by=("event_date",))
    return spark.read.schema(table.schema).parquet(f"{root}/table")


def tumbling_totals(payments: DataFrame, at: str, watermark: str | None = None, size: str = "1 minute") -> DataFrame:
    """Count and sum per status and aligned window ``[start, end)``; late rows are dropped on streams."""
    if watermark is not None:
        payments = payments.withWatermark(at, watermark)
    return payments.groupBy(F.window(at, size).alias("_w"), "status").agg(
        F.count("*").alias("payment_count"), F.sum("amount").alias("total_amount"),
    ).select(F.col("_w.start").alias("window_start"), "status", "payment_count", "total_amount")


def recent_distinct(log: DataFrame, at: str, horizon: str) -> DataFrame:
    """Deliveries once each, with state bounded by the watermark instead of a ledger."""
    return log.withWatermark(at, horizon).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


class LatestTable:
    """Latest value of each column per key, held in the state of a streaming aggregate and read from its checkpoint.

    A pull query asks the state store, which has one row per key, so its cost follows the number of keys and not the
    number of batches. Each column is folded on its own: the newest value that is not null.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, key: str, values: dict[str, T.DataType]):
        self.spark, self.checkpoint, self.key, self.values = spark, checkpoint.rstrip("/"), key, values

    def fold(self, rows: DataFrame) -> DataFrame:
        """The aggregate over rows (key, partition, offset, values...); on a stream, its state is the table."""
        at = F.struct("partition", "offset")
        return rows.groupBy(self.key).agg(*[
            F.max(F.when(F.col(v).isNotNull(), F.struct(at.alias("at"), F.col(v).alias(v)))).alias(v) for v in self.values])

    def run(self, rows: DataFrame) -> StreamingQuery:
        """Fold all rows that are there now into the state; nothing else is written."""
        return drain(self.fold(rows), lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save(), self.checkpoint, "update")

    def current(self, **options: str) -> DataFrame:
        """``key, values...`` as of the last committed batch, or of ``batchId`` among the options."""
        state = self.spark.read.format("statestore").options(**options).load(self.checkpoint)
        # The state holds one buffer per aggregate, in their order and under one name: told apart by position.
        place = "struct<`partition`:int,`offset`:bigint>"
        cells = ",".join(f"`{v}`:struct<at:{place},v:{t.simpleString()}>" for v, t in self.values.items())
        named = state.select(F.col("key").getField(self.key).alias(self.key), F.col("value").cast(f"struct<{cells}>").alias("_v"))
        return named.select(self.key, *[F.col("_v").getField(v).getField("v").alias(v) for v in self.values])

    def pull(self, value) -> DataFrame:
        """The row of one key."""
        return lookup_one(self.current(), self.key, value)

    def state_metadata(self) -> DataFrame:
        """Operators of the query with their state stores and the batches that can be read."""
        return self.spark.read.format("state-metadata").load(self.checkpoint)


def lookup(view: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Pull query: the current rows of the keys asked for."""
    return view.join(keys.select(key).distinct(), key, "left_semi")


def lookup_one(view: DataFrame, key: str, value) -> DataFrame:
    return view.filter(F.col(key) == F.lit(value))


def relay_writer(path: str, topic_template: str = "{aggregatetype}"):
    """``foreachBatch`` function: outbox rows as keyed records, one folder per batch and topic.

    The folder of a retried batch is overwritten, so each committed row is published once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        relay(batch, topic_template).write.mode("overwrite").partitionBy("topic").parquet(f"{path}/batch_id={batch_id}")
    return write


def transform_log(log: DataFrame, handler) -> DataFrame:
    """Per-record handler: ``handler(value Column) -> Column`` gives the new value; null drops the record."""
    return log.withColumn("value", handler(F.col("value"))).filter(F.col("value").isNotNull())


def call_downstream(df: DataFrame, call, schema: str) -> DataFrame:
    """Records through a real client: ``call`` maps pandas batches, for outcomes no column rule gives."""
    return df.mapInPandas(call, schema)
