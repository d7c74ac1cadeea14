"""The four services as projections from the records they consume to the outbox rows that they publish.

Every event has an id derived from the event that caused it, and carries its trace context in the payload: a replay repeats
both, an event that is sent again gets its own. A relayed record tells the id of its event in the header ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtide.functions import rules as R
from logtide.functions.tracecontext import carried_first, child_of, root_of
from logtide.operators.decode import computed_once
from logtide.operators.delivery import outbox_rows
from logtide.operators.retry import with_final_outcome

#: The work that each event type reports, which names its span.
HOPS = {
    "OrderCreated": "order.create", "PaymentSucceeded": "payment.process", "PaymentFailed": "payment.process",
    "InventoryReserved": "inventory.reserve", "CompensationRequested": "inventory.reserve", "PaymentRefunded": "payment.compensate",
    "ShipmentCreated": "shipping.create",
}
#: The work that the consumer of each topic does on its records; a topic has one consumer.
CONSUMED = {
    "orders": "payment.process", "payment-compensation": "payment.compensate", "payments": "inventory.reserve",
    "inventory": "shipping.create",
}
OUTBOX = ("id", "aggregatetype", "aggregateid", "type", "payload", "created_at")


def _rows(events: DataFrame, aggregate_type: str, event_type: Column, payload: Column, cause: tuple[str, ...], at: str) -> DataFrame:
    rows = outbox_rows(events.withColumn("_at", F.col(at)), aggregate_type, "order_id", event_type, payload, cause, keep=("_at",))
    return rows.withColumnRenamed("_at", "created_at").select(*OUTBOX)


def _payload(event_type: Column, context: Column, *fields: Column) -> Column:
    return F.to_json(F.struct(event_type.alias("type"), F.col("order_id").alias("orderId"), *fields,
                              F.struct(context.alias("traceparent")).alias("traceContext")))


def relayed(outbox: DataFrame) -> DataFrame:
    """Outbox rows as the records of their topics: ``topic, key, value, headers, timestamp``, the event's id in the headers."""
    return outbox.select(F.col("aggregatetype").alias("topic"), F.col("aggregateid").alias("key"), F.col("payload").alias("value"),
                         F.create_map(F.lit("id"), F.col("id")).alias("headers"), F.col("created_at").alias("timestamp"))


def with_payload(records: DataFrame, fields: str = "") -> DataFrame:
    """Add ``payload``, the fields of the values and their ``traceContext``, all of one parse: parsing is most of a hop's work."""
    schema = "traceContext struct<traceparent: string>" + (f", {fields}" if fields else "")
    return computed_once(records, payload=F.from_json("value", schema))


def _consumed(records: DataFrame, topic: str, schema: str = "", **fields: Column) -> DataFrame:
    """``order_id, cause, at, context`` of the work on a topic's records, and ``fields`` of their payloads, read by ``schema``.

    Each is computed once per record, so hops can follow each other in one plan without copying each other's expressions.
    """
    parsed = with_payload(records.where(F.col("topic") == topic), schema)
    context = carried_first(F.col("headers"), F.col("payload.traceContext.traceparent"))
    read = parsed.select("key", "headers", "timestamp", context.alias("_carried"), *[c.alias(name) for name, c in fields.items()])
    made = computed_once(read, context=child_of(F.col("_carried"), F.lit(CONSUMED[topic])))
    return made.select(F.col("key").alias("order_id"), F.element_at("headers", "id").alias("cause"), F.col("timestamp").alias("at"), "context", *fields)


def order_service(sends: DataFrame, delivery: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """``OrderCreated`` for every order sent: rows (key, value = order JSON, timestamp, delivery...). Each send opens a trace."""
    orders = sends.withColumnRenamed("key", "order_id")
    seed = F.concat_ws("/", "order_id", *[F.col(c).cast("string") for c in delivery])
    context = root_of(seed, F.lit(HOPS["OrderCreated"]))
    payload = F.concat(F.lit('{"type":"OrderCreated","order":'), F.col("value"), F.lit(',"traceContext":{"traceparent":"'), context, F.lit('"}}'))
    return _rows(orders, "orders", F.lit("OrderCreated"), payload, delivery, "timestamp")


def payment_service(records: DataFrame) -> DataFrame:
    """``PaymentSucceeded`` or ``PaymentFailed`` for orders, ``PaymentRefunded`` for requests of compensation."""
    total = F.col("payload.order.total").cast("double")
    orders = with_final_outcome(_consumed(records, "orders", "order struct<total: string>", amount=total))
    failed = R.is_declined(F.col("order_id")) | F.col("exhausted")
    event = F.when(failed, "PaymentFailed").otherwise("PaymentSucceeded")
    status = F.when(failed, "failed").otherwise("succeeded").alias("status")
    paid = _rows(orders, "payments", event, _payload(event, F.col("context"), F.col("amount"), status), ("cause",), "at")
    asked = _consumed(records, "payment-compensation", "reason string", reason=F.col("payload.reason"))
    refund = F.lit("PaymentRefunded")
    body = _payload(refund, F.col("context"), F.lit("refunded").alias("status"), F.col("reason"))
    return paid.unionByName(_rows(asked, "payments", refund, body, ("cause",), "at"))


def inventory_service(records: DataFrame) -> DataFrame:
    """``InventoryReserved``, or ``CompensationRequested`` where stock is out, for fresh successful payments.

    Refunds share the topic of payments: going on from them would close a loop, so all but ``succeeded`` is skipped.
    """
    paid = _consumed(records, "payments", "status string", status=F.col("payload.status")).where("status = 'succeeded'")
    out, context = R.is_out_of_stock(F.col("order_id")), F.col("context")
    reserved, asked = F.lit("InventoryReserved"), F.lit("CompensationRequested")
    return _rows(paid.where(~out), "inventory", reserved, _payload(reserved, context, F.lit(True).alias("reserved")), ("cause",), "at").unionByName(
        _rows(paid.where(out), "payment-compensation", asked, _payload(asked, context, F.lit(R.OUT_OF_STOCK_REASON).alias("reason")), ("cause",), "at"))


def shipping_service(records: DataFrame) -> DataFrame:
    """``ShipmentCreated`` for every reservation."""
    reserved, event = _consumed(records, "inventory"), F.lit("ShipmentCreated")
    tracking = R.tracking_id(F.col("order_id"), F.col("at")).alias("trackingId")
    return _rows(reserved, "shipping", event, _payload(event, F.col("context"), tracking), ("cause",), "at")


def published_spans(records: DataFrame) -> DataFrame:
    """``trace_id, span_id, parent_span_id, name, event_type, service`` rebuilt from published payloads alone.

    A payload tells its trace and its own span, not its parent. The parent is the span of the trace from which the hop's
    rule gives this span: each span offers the id of the span that the consumer of its topic makes of it. On topics of other
    consumers it offers one per hop.
    """
    event, context = F.col("payload.type"), F.col("payload.traceContext.traceparent")
    name = F.element_at(F.create_map(*[F.lit(x) for pair in HOPS.items() for x in pair]), event)
    hops = F.array(*[F.lit(h) for h in dict.fromkeys(HOPS.values()) if h != HOPS["OrderCreated"]])
    next_hop = F.element_at(F.create_map(*[F.lit(x) for pair in CONSUMED.items() for x in pair]), F.col("topic"))
    may_follow = F.when(next_hop.isNotNull(), F.array(next_hop)).otherwise(hops)
    spans = with_payload(records, "type string").select(event.alias("event_type"), name.alias("name"), F.split(context, "-").alias("_c"), may_follow.alias("_hops")).select(
        F.get("_c", F.lit(1)).alias("trace_id"), F.get("_c", F.lit(2)).alias("span_id"), "name", "event_type", "_hops",
        F.concat(F.substring_index("name", ".", 1), F.lit("-service")).alias("service"))
    parent = F.concat_ws("-", F.lit("00"), "trace_id", "span_id", F.lit("01"))
    offers = spans.select("trace_id", F.col("span_id").alias("parent_span_id"), parent.alias("_p"), F.explode("_hops").alias("_hop")).select(
        "trace_id", "parent_span_id", F.get(F.split(child_of(F.col("_p"), F.col("_hop")), "-"), F.lit(2)).alias("span_id"))
    return spans.join(offers, ["trace_id", "span_id"], "left").select("trace_id", "span_id", "parent_span_id", "name", "event_type", "service")
