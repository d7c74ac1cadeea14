"""Queries over decoding, projection and key functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logtide import schemas as S
from logtide.functions import rules as R
from logtide.functions.hashing import murmur2, placement
from logtide.functions.jsontext import json_literal
from logtide.functions.tracecontext import carried, inject, parent_of
from logtide.operators.decode import (
    ORDER_PATHS, PAYMENT_PATHS, declare, raw_to_typed, shape_guard, unwrap_log, with_reject_reason,
)
from logtide.operators.partitions import salt_keys
from logtide.plans import derived as D
from logtide.plans.oracle import murmur2 as murmur2_sql, partition as partition_sql
from logtide.plans.registry import query


@query("safe_parse_split", """
    SELECT order_id AS key, order_no % 97 <> 0 AS parsed, CASE WHEN order_no % 97 = 0 THEN 'invalid_json' END AS reason
    FROM f_orders""", ("f_orders",))
def safe_parse_split(spark: SparkSession, sf: str) -> DataFrame:
    log = with_reject_reason(D.dirty(D.log_orders(spark, sf)).select("key", "value"))
    return log.select("key", F.col("reject_reason").isNull().alias("parsed"), F.col("reject_reason").alias("reason"))


@query("outbox_unwrap", """
    SELECT order_id AS key,
           CASE WHEN order_no % 97 = 0 THEN 'poison' WHEN order_no % 11 = 0 THEN 'flat' ELSE 'enveloped' END AS form,
           CASE WHEN order_no % 97 <> 0 THEN order_id END AS order_id
    FROM f_orders""", ("f_orders",))
def outbox_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    log = D.enveloped(D.log_orders(spark, sf)).withColumn(
        "value", F.when(D.order_no("key") % 97 == 0, F.lit("heyyy")).otherwise(F.col("value")))
    inner = F.coalesce(F.get_json_object("document", "$.order.orderId"), F.get_json_object("document", "$.orderId"))
    form = F.when(F.col("document").isNull(), "poison").when(F.col("literal"), "enveloped").otherwise("flat")
    return unwrap_log(log.select("key", "value")).select("key", form.alias("form"), inner.alias("order_id"))


@query("raw_to_typed_orders", """
    SELECT order_id, customer_id, round(total, 2) AS total, 'created' AS status
    FROM f_orders WHERE order_no % 11 <> 0""", ("f_orders",))
def raw_to_typed_orders(spark: SparkSession, sf: str) -> DataFrame:
    raw = D.enveloped(D.log_orders(spark, sf)).select(F.col("value").alias("raw"))
    return raw_to_typed(raw, ORDER_PATHS, "order_id").withColumn("total", F.round("total", 2))


@query("raw_to_typed_payments", """
    SELECT order_id, round(coalesce(amount, 0), 2) AS amount, status FROM f_payment_events""", ("f_payment_events",))
def raw_to_typed_payments(spark: SparkSession, sf: str) -> DataFrame:
    raw = D.log_payments(spark, sf).select(json_literal(F.col("value")).alias("raw"))
    return raw_to_typed(raw, PAYMENT_PATHS, "order_id").withColumn("amount", F.round("amount", 2))


@query("event_time_cast", """
    SELECT event_id, make_timestamp(event_time * 1000) AS event_time,
           strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS event_date,
           strftime(make_timestamp(event_time * 1000), '%Y%m') AS event_month
    FROM f_events""", ("f_events",))
def event_time_cast(spark: SparkSession, sf: str) -> DataFrame:
    at = F.timestamp_millis("event_time")
    return D.analytics_events(spark, sf).select(
        "event_id", at.alias("event_time"), F.to_date(at).cast("string").alias("event_date"), F.date_format(at, "yyyyMM").alias("event_month"))


@query("json_encode", """
    SELECT order_id, 'PaymentSucceeded' AS type, round(amount, 2) AS amount, coalesce(n, 0) AS n_items,
           order_no AS nested_no
    FROM f_payments LEFT JOIN (SELECT order_no, count(*) AS n FROM f_items GROUP BY order_no) USING (order_no)
    WHERE status = 'succeeded'""", ("f_payments", "f_items"))
def json_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Payments encoded as nested JSON, then read back by declared schema."""
    body = F.to_json(F.struct(
        F.lit("PaymentSucceeded").alias("type"),
        F.struct(F.col("order_id").alias("orderId"), "items", D.order_no().alias("no")).alias("order"),
        "amount"))
    docs = D.payments(spark, sf, with_items=True).filter(F.col("status") == "succeeded").select(body.alias("value"))
    schema = S.T.StructType().add("type", "string").add("amount", "double").add(
        "order", S.T.StructType().add("orderId", "string").add("items", S.ITEMS).add("no", "long"))
    return declare(docs, schema).select(
        F.col("order.orderId").alias("order_id"), "type", F.round("amount", 2).alias("amount"),
        F.size("order.items").cast("bigint").alias("n_items"), F.col("order.no").alias("nested_no"))


ATTACHMENT_SHAPE = {"eventId": "string", "bucket": "string", "key": "string", "sizeBytes": "number",
                    "checksum": "string", "contentType": "string"}


@query("shape_guard", """
    SELECT doc_id, NOT (doc_id % 17 = 0 OR doc_id % 10 = 0 OR doc_id % 15 = 0) AS shape_ok FROM documents""")
def shape_guard_query(spark: SparkSession, sf: str) -> DataFrame:
    """References of which some are not JSON, some are page views, some have a text as size."""
    n = F.col("doc_id")
    fields = [F.col("event_id").alias("eventId"), F.lit("attachments").alias("bucket"), F.col("key")]
    tail = [F.col("checksum"), F.lit("text/plain").alias("contentType")]
    good = F.to_json(F.struct(*fields, F.col("size_bytes").alias("sizeBytes"), *tail))
    text_size = F.to_json(F.struct(*fields, F.col("size_bytes").cast("string").alias("sizeBytes"), *tail))
    view = F.lit('{"kind":"visit","visitor":7,"address":"/catalogue"}')
    refs = D.attachment_refs(spark, sf).withColumn("doc_id", F.substring_index("event_id", "-", -1).cast("bigint"))
    log = refs.select("doc_id", F.when(n % 17 == 0, F.lit("heyyy")).when(n % 15 == 0, view).when(n % 10 == 0, text_size)
                      .otherwise(good).alias("value"))
    return shape_guard(log, ATTACHMENT_SHAPE).select("doc_id", "shape_ok")


@query("scenario_class", "SELECT order_id, scenario FROM f_orders", ("f_orders",))
def scenario_class(spark: SparkSession, sf: str) -> DataFrame:
    return D.orders(spark, sf).select("order_id", R.scenario(F.col("order_id")).alias("scenario"))


@query("partition_assign", f"""
    SELECT order_id AS key, {murmur2_sql('order_id')} AS hash, {partition_sql('order_id', 3)} AS partition_3,
           {partition_sql('order_id', 24)} AS partition_24
    FROM f_orders""", ("f_orders",))
def partition_assign(spark: SparkSession, sf: str) -> DataFrame:
    hashed = D.orders(spark, sf).select(F.col("order_id").alias("key"), murmur2(F.col("order_id")).alias("hash"))
    return hashed.select("key", "hash", placement(F.col("hash"), 3).alias("partition_3"),
                         placement(F.col("hash"), 24).alias("partition_24"))


@query("salt_keys", f"""
    SELECT event_id, salted_key, part AS "partition"
    FROM (SELECT event_id, CASE WHEN key = 'customer-VIP' THEN key || '#' || event_id % 8 ELSE key END AS salted_key FROM f_skewed)
    JOIN (SELECT salted_key, {partition_sql('salted_key', 6)} AS part FROM (
          SELECT DISTINCT CASE WHEN key = 'customer-VIP' THEN key || '#' || event_id % 8 ELSE key END AS salted_key FROM f_skewed))
    USING (salted_key)""", ("f_skewed",))
def salt_keys_query(spark: SparkSession, sf: str) -> DataFrame:
    salted = salt_keys(D.skewed(spark, sf), "key", F.col("key") == "customer-VIP", 8, "event_id")
    return salted.select("event_id", "salted_key", placement(murmur2(F.col("salted_key")), 6).alias("partition"))


@query("trace_extract", """
    SELECT order_id AS key, CASE WHEN order_no % 7 <> 0 THEN md5(order_id) END AS trace_id,
           CASE WHEN order_no % 7 <> 0 THEN substr(md5(customer_id), 1, 16) END AS parent_span_id,
           order_no % 7 = 0 AS starts_trace
    FROM f_orders""", ("f_orders",))
def trace_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts carried in headers (even orders) or in the payload (odd ones); every 7th has none."""
    n = F.col("order_no")
    trace, span = F.md5("order_id"), F.substring(F.md5("customer_id"), 1, 16)
    bare = F.create_map().cast("map<string,string>")
    headers = F.when((n % 7 != 0) & (n % 2 == 0), inject(bare, trace, span)).otherwise(bare)
    embedded = F.to_json(F.struct(F.struct(F.concat_ws("-", F.lit("00"), trace, span, F.lit("01")).alias("traceparent"))
                                  .alias("traceContext")))
    payload = F.when((n % 7 != 0) & (n % 2 == 1), embedded).otherwise(F.lit("{}"))
    found = D.orders(spark, sf).select(F.col("order_id").alias("key"), parent_of(carried(headers, payload)).alias("p"))
    return found.select("key", "p.trace_id", "p.parent_span_id", F.col("p").isNull().alias("starts_trace"))


@query("unnest_batch", """
    SELECT part AS "partition", pos // 500 AS batch_id, pos AS "offset", order_id, round(total, 2) AS total
    FROM f_log_orders""", ("f_log_orders",))
def unnest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of at most 500 log rows as parallel arrays, and back to rows."""
    rows = D.log_orders(spark, sf).select(
        "partition", F.floor(F.col("offset") / 500).alias("batch_id"),
        F.struct("offset", F.col("key").alias("order_id"), F.get_json_object("value", "$.total").cast("double").alias("total")).alias("r"))
    batches = rows.groupBy("partition", "batch_id").agg(F.collect_list("r").alias("r")).select(
        "partition", "batch_id", F.col("r.offset").alias("offsets"), F.col("r.order_id").alias("order_ids"),
        F.col("r.total").alias("totals"))
    return batches.select("partition", "batch_id", F.inline(F.arrays_zip("offsets", "order_ids", "totals")).alias(
        "offset", "order_id", "total")).withColumn("total", F.round("total", 2))


@query("flatten_items", """
    SELECT order_id, sku, CAST(qty AS INTEGER) AS qty FROM f_orders LEFT JOIN f_items USING (order_no)""",
       ("f_orders", "f_items"))
def flatten_items(spark: SparkSession, sf: str) -> DataFrame:
    orders = declare(D.log_orders(spark, sf), S.ORDER)
    return orders.select(F.col("orderId").alias("order_id"), F.explode_outer("items").alias("i")).select(
        "order_id", "i.sku", "i.qty")
