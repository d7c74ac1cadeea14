"""Event views over the benchmark tables.

The tables are a star schema, not logs. These views turn them into orders, payments,
logs, blobs, metrics and spans by plain rules that DuckDB can repeat. Logs need offsets,
which take a sort of the whole topic, so each log is written once per application and
input folder, and queries then scan it like any stored topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logtide.functions import rules as R
from logtide.functions.jsontext import json_literal
from logtide.operators import services
from logtide.operators.stages import refund_events, to_compensation, to_payments, to_refunds
from logtide.session import scratch_path
from logtide.sinks.log import append_log, place, to_log
from logtide.sources.log import read_log
from logtide.sources.tables import table

PARTITIONS = 3
SCENARIOS = ("happy", "payment-declined", "out-of-stock", "transient-fail-3", "permanent-fail")

_logs: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A derived log, stored at its first use in this application and scanned like any stored topic after that."""
    slot = (spark.sparkContext.applicationId, sf, name)
    if slot not in _logs:
        path = scratch_path(spark, name)
        append_log(build(), path)
        _logs[slot] = path
    return read_log(spark, _logs[slot])


def as_stream(spark: SparkSession, sf: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A derived log that is stored already, as a stream over its files."""
    path = _logs[(spark.sparkContext.applicationId, sf, name)]
    return read_log(spark, path, streaming=True, max_files_per_trigger=max_files_per_trigger)


def order_no(order_id: str = "order_id") -> Column:
    return F.substring_index(F.col(order_id), "-", -1).cast("bigint")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without their items: order_no, order_id, customer_id, total, status, ts."""
    o = table(spark, sf, "orders")
    scenario = F.element_at(F.array(*[F.lit(s) for s in SCENARIOS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("order_no"),
        F.concat(F.lit("order-"), scenario, F.lit("-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_totalprice").alias("total"), F.lit("created").alias("status"),
        F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") % 86_400).alias("ts"))


def full_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their items. An order is one record, so its items fit in one row.

    Lines are dealt by order before they are collected: collecting reduces nothing, so a
    first round inside the scan tasks would only sort the lines once more.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_no"), F.struct("l_linenumber", "l_partkey", "l_quantity").alias("_l"))
    # The columns move as they are; an item is made of them after its order is put together.
    gathered = lines.repartition("order_no").groupBy("order_no").agg(F.sort_array(F.collect_list("_l")).alias("_l"))
    items = F.transform("_l", lambda line: F.struct(F.concat(F.lit("sku-"), line["l_partkey"].cast("string")).alias("sku"),
                                                    line["l_quantity"].cast("int").alias("qty")))
    none = F.array().cast("array<struct<sku:string,qty:int>>")
    return orders(spark, sf).join(gathered, "order_no", "left").select(
        "order_no", "order_id", "customer_id", F.coalesce(items, none).alias("items"), "total", "status", "ts")


def order_json() -> Column:
    return F.to_json(F.struct(
        F.col("order_id").alias("orderId"), F.col("customer_id").alias("customerId"), "items", "total", "status"))


def payment_json() -> Column:
    return F.to_json(F.struct(
        F.col("order_id").alias("orderId"), "items", "amount", "status",
        R.iso_instant(F.col("processed_at")).alias("processedAt")))


def log_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Topic ``orders``, flat JSON values."""
    def build() -> DataFrame:
        records = to_log(full_orders(spark, sf), F.col("order_id"), F.lit("orders"), order_json(), F.col("ts"))
        return place(records.withColumn("_no", order_no("key")), PARTITIONS, ["timestamp", "_no"])
    return once(spark, sf, "log-orders", build)


def payments(spark: SparkSession, sf: str, with_items: bool = False) -> DataFrame:
    """Payments of all orders, some time after the order (up to three hours)."""
    source = full_orders(spark, sf) if with_items else orders(spark, sf).withColumn(
        "items", F.lit(None).cast("array<struct<sku:string,qty:int>>"))
    paid_at = F.timestamp_seconds(F.unix_seconds("ts") + (F.col("order_no") * 37) % 10_800)
    return to_payments(source.withColumn("paid_at", paid_at), at="paid_at")


def compensation(spark: SparkSession, sf: str) -> DataFrame:
    return to_compensation(payments(spark, sf))


def refunds(spark: SparkSession, sf: str) -> DataFrame:
    """Refunds are issued one minute after the payment they reverse."""
    late = compensation(spark, sf).withColumn(
        "requested_at", F.timestamp_seconds(F.unix_seconds("requested_at") + 60))
    return to_refunds(late)


def log_payments(spark: SparkSession, sf: str) -> DataFrame:
    """Topic ``payments``: payments and the refund events that share the topic."""
    def build() -> DataFrame:
        paid = to_log(payments(spark, sf, with_items=True), F.col("order_id"), F.lit("payments"), payment_json(),
                      F.col("processed_at"))
        refund = refund_events(refunds(spark, sf))
        body = F.to_json(F.struct(F.lit("PaymentRefunded").alias("type"), F.col("order_id").alias("orderId"), "status",
                                  F.lit(R.OUT_OF_STOCK_REASON).alias("reason")))
        back = to_log(refund, F.col("order_id"), F.lit("payments"), body, F.col("processed_at"))
        both = paid.withColumn("_kind", F.lit(0)).unionByName(back.withColumn("_kind", F.lit(1)))
        return place(both.withColumn("_no", order_no("key")), PARTITIONS, ["timestamp", "_kind", "_no"])
    return once(spark, sf, "log-payments", build)


def enveloped(log: DataFrame) -> DataFrame:
    """Double-encoded values as a relay of a text column publishes them; every 11th is old flat JSON."""
    inner = F.concat(F.lit('{"type":"OrderCreated","order":'), F.col("value"), F.lit("}"))
    return log.withColumn("value", F.when(order_no("key") % 11 == 0, F.col("value")).otherwise(json_literal(inner)))


def dirty(log: DataFrame) -> DataFrame:
    """Poison (``heyyy``) at every 97th order, a page view in place of the order at every 89th."""
    n = order_no("key")
    return log.withColumn("value", F.when(n % 97 == 0, F.lit("heyyy")).when(n % 89 == 0, F.lit('{"page":"/home"}'))
                          .otherwise(F.col("value")))


def deliveries(log: DataFrame) -> DataFrame:
    """Deliveries of a log, attempt 2 for offsets ending in 3; ``delivery_seq`` orders the copies."""
    attempts = F.when(F.col("offset") % 10 == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return log.withColumn("delivery_seq", F.explode(attempts))


def with_batch(log: DataFrame, rows: int = 500) -> DataFrame:
    """Micro-batch of each delivery: a redelivered record comes again in the next batch."""
    return log.withColumn("batch_id", F.floor(F.col("offset") / rows) + F.col("delivery_seq") - 1)


def analytics_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", F.unix_millis("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type")).alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("prod-"), (F.col("event_id") % 200).cast("string")).alias("product_id"),
        F.concat(F.lit("cat-"), (F.col("event_id") % 6).cast("string")).alias("category"),
        F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("country"),
        F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0)).alias("amount"))


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter(F.col("event_type") == "click")
    return e.select(F.col("user_id").cast("string").alias("user_id"), F.col("props").alias("page"),
                    F.col("ts").alias("click_ts"))


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").filter(F.col("event_type") == "signup")
    return e.select(F.col("user_id").cast("string").alias("user_id"),
                    F.concat(F.lit("d"), (F.col("event_id") % 3).cast("string")).alias("device"),
                    F.col("ts").alias("session_ts"))


def skewed(spark: SparkSession, sf: str) -> DataFrame:
    """Events keyed so that one customer has four fifths of them."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id", "ts", "value",
        F.when(F.col("event_id") % 5 != 0, F.lit("customer-VIP"))
        .otherwise(F.concat(F.lit("customer-"), F.col("user_id").cast("string"))).alias("key"))


def blobs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter(F.col("doc_id") % 70 != 0)
    return d.select(F.concat(F.lit("attachments/"), F.col("doc_id").cast("string")).alias("key"),
                    F.col("text").alias("content"))


def attachment_refs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    sha = F.sha2("text", 256)
    return d.select(
        F.concat(F.lit("event-"), F.col("doc_id").cast("string")).alias("event_id"),
        F.concat(F.lit("attachments/"), F.col("doc_id").cast("string")).alias("key"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.when(F.col("doc_id") % 50 == 0, F.reverse(sha)).otherwise(sha).alias("checksum"))


def resent(log: DataFrame) -> DataFrame:
    """The log with every 5th record sent again later: same key, new offset, new delivery, marked ``again``."""
    times = F.when(F.col("offset") % 5 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    again, both = F.col("again"), log.withColumn("again", F.explode(times))
    later = {"offset": F.col("offset") + F.lit(10 ** 12), "timestamp": F.timestamp_seconds(F.unix_seconds("timestamp") + 86_400)}
    return both.select(*[F.when(again, later[c]).otherwise(F.col(c)).alias(c) if c in later else c for c in log.columns], "again")


def published_events(spark: SparkSession, sf: str) -> DataFrame:
    """The outbox of all four services for the orders log in which every 5th order was sent twice.

    Each service consumes what the relay published of the ones before it. An outbox is a stored table: the rows of a
    service are written once, into a folder of it, and read there by those behind it and by the queries.
    """
    slot, rounds = (spark.sparkContext.applicationId, sf, "outbox"), ("created", "paid", "held", "last")
    if slot not in _logs:
        path = scratch_path(spark, "outbox")

        def stored(rows: DataFrame, name: str) -> DataFrame:
            # Ids and payloads do not repeat, so a dictionary of them is built and thrown away.
            plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("id", "aggregateid", "payload")}
            rows.write.options(**plain).option("compression", "zstd").parquet(f"{path}/{name}")
            return services.relayed(spark.read.schema(rows.schema).parquet(f"{path}/{name}"))

        created = stored(services.order_service(resent(log_orders(spark, sf))), "created")
        paid = stored(services.payment_service(created), "paid")
        held = stored(services.inventory_service(paid), "held")
        stored(services.payment_service(held).unionByName(services.shipping_service(held)), "last")
        _logs[slot] = path
    return spark.read.parquet(*[f"{_logs[slot]}/{r}" for r in rounds]).select(*services.OUTBOX)


def group_offsets(log: DataFrame) -> DataFrame:
    """Committed offsets of two consumer groups: 90 % and 50 % of each partition."""
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
    groups = F.array(F.struct(F.lit("payment-service").alias("g"), F.lit(9).alias("tenths")),
                     F.struct(F.lit("inventory-service").alias("g"), F.lit(5).alias("tenths")))
    return ends.select("topic", "partition", "end", F.inline(groups)).select(
        F.col("g").alias("consumer_group"), "topic", "partition",
        F.floor(F.col("end") * F.col("tenths") / 10).alias("committed"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counter samples per minute and event type, reset to zero every 1,000 minutes."""
    minute = F.floor(F.unix_seconds("ts") / 60)
    per_minute = table(spark, sf, "events").groupBy("event_type", minute.alias("minute")).agg(F.count("*").alias("n"))
    # At most 1,000 minutes per window group, whatever the number of events.
    epoch = Window.partitionBy("event_type", F.floor(F.col("minute") / 1000)).orderBy("minute").rowsBetween(
        Window.unboundedPreceding, 0)
    return per_minute.select(
        F.timestamp_seconds(F.col("minute") * 60).alias("ts"), F.lit("events_total").alias("name"),
        F.col("event_type"), F.sum("n").over(epoch).cast("double").alias("value"))


def service_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly samples of two counters of the payment service, which restarts every day."""
    paid = payments(spark, sf)
    dead = (F.col("status") == "failed") & ~R.is_declined(F.col("order_id"))
    back = (F.col("status") == "succeeded") & R.is_out_of_stock(F.col("order_id"))
    name = F.when(dead, "dlq_messages_total").when(back, "compensations_total")
    hour = F.floor(F.unix_seconds("processed_at") / 3600)
    hourly = paid.select(name.alias("name"), hour.alias("hour")).filter(F.col("name").isNotNull()).groupBy("name", "hour").agg(
        F.count("*").alias("n"))
    day = Window.partitionBy("name", F.floor(F.col("hour") / 24)).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select(F.timestamp_seconds(F.col("hour") * 3600).alias("ts"), "name",
                         F.lit("payment-service").alias("service"), F.sum("n").over(day).cast("double").alias("value"))


def all_spans(spark: SparkSession, sf: str) -> DataFrame:
    """A span per hop that each order reached, whatever became of it, one second long, with growing gaps; every 200th order
    lost its root.

    Every order is created and paid for or refused, and inventory looks at every payment event. What it reserves is shipped;
    what is out of stock is compensated, and inventory sees the refund too, which shares the topic of payments.
    """
    hops = ["order.create", "payment.process", "inventory.reserve"]
    tail = F.when(R.is_out_of_stock(F.col("order_id")), F.array(F.lit("payment.compensate"), F.lit("inventory.reserve"))).when(
        F.col("status") == "succeeded", F.array(F.lit("shipping.create"))).otherwise(F.array().cast("array<string>"))
    reached = F.concat(F.array(*[F.lit(h) for h in hops]), tail)
    created = orders(spark, sf).select("order_no", "order_id", "ts", "total", F.lit(None).cast("array<struct<sku:string,qty:int>>").alias("items"))
    each = to_payments(created, "ts", extra=("order_no", "ts")).select("order_no", "order_id", "ts", F.posexplode(reached).alias("hop", "name"))
    start = F.timestamp_seconds(F.unix_seconds("ts") + F.col("hop") * 2 + F.when(F.col("hop") >= 3, F.col("order_no") % 7)
                                .otherwise(F.lit(0)))
    return each.filter(~((F.col("order_no") % 200 == 0) & (F.col("hop") == 0))).select(
        F.concat(F.lit("trace-"), F.col("order_id")).alias("trace_id"),
        F.concat_ws("/", "order_id", F.col("hop").cast("string")).alias("span_id"),
        F.when(F.col("hop") > 0, F.concat_ws("/", "order_id", (F.col("hop") - 1).cast("string"))).alias("parent_span_id"),
        F.concat(F.substring_index("name", ".", 1), F.lit("-service")).alias("service"), "name", start.alias("start"),
        F.timestamp_seconds(F.unix_seconds(start) + 1).alias("end"))


def transactional(log: DataFrame) -> DataFrame:
    """A log with transactions: data at even offsets, the control record after it.

    Every 10th order is outside transactions, every 7th attempt aborts, every 31st is left
    without a control record.
    """
    n = order_no("key")
    producer = F.when(n % 10 != 0, F.concat(F.lit("tx-"), (n % 4).cast("string")))
    outcome = F.when(n % 7 == 0, "ABORT").otherwise("COMMIT")
    data = F.struct((F.col("offset") * 2).alias("offset"), F.col("key").alias("key"), F.lit(None).cast("string").alias("control"))
    mark = F.struct((F.col("offset") * 2 + 1).alias("offset"), F.lit(None).cast("string").alias("key"), outcome.alias("control"))
    closed = (n % 10 != 0) & (n % 31 != 0)
    rows = F.when(closed, F.array(data, mark)).otherwise(F.array(data))
    return log.select("topic", "partition", producer.alias("producer_id"), F.inline(rows))
