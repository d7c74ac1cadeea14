"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide import schemas as S
from logtide.functions.tracecontext import carried_first
from logtide.operators.claims import classify, digest, offload
from logtide.operators.decode import Writer, block_errors, declare, read_framed, read_versions, wire_header, with_reject_reason
from logtide.operators.gate import gate_rows
from logtide.operators.retry import dead_letters
from logtide.operators.services import published_spans, relayed, with_payload
from logtide.plans import derived as D
from logtide.plans.registry import query
from logtide.session import scratch_path
from logtide.sinks.tables import codec_footprint, read_quarantine, read_sink_lines, write_clustered, write_sorted_out
from logtide.sources.files import raw_landing
from logtide.sources.incremental import incremental_read
from logtide.sources.tables import table
from logtide.sources.tail import LINES, tail_lines
from logtide.streaming.jobs import drain, ingest_events
from logtide.streaming.polling import Polling


@query("log_scan", """
    SELECT order_id AS key, 'orders' AS topic, part AS "partition", pos AS "offset", ts AS "timestamp",
           round(total, 2) AS total
    FROM f_log_orders""", ("f_log_orders",))
def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    return D.log_orders(spark, sf).select(
        "key", "topic", "partition", "offset", "timestamp",
        F.round(F.get_json_object("value", "$.total").cast("double"), 2).alias("total"))


@query("multi_topic_scan", """
    SELECT 'orders' AS topic, part AS "partition", 'order' AS branch, count(*) AS records, max(pos) AS last_offset
    FROM f_log_orders GROUP BY ALL
    UNION ALL
    SELECT 'payments', part, status, count(*), max(pos) FROM f_log_payments GROUP BY ALL""",
       ("f_log_orders", "f_log_payments"))
def multi_topic_scan(spark: SparkSession, sf: str) -> DataFrame:
    both = D.log_orders(spark, sf).unionByName(D.log_payments(spark, sf)).filter(
        F.col("topic").isin("orders", "payments"))
    branch = F.when(F.col("topic") == "orders", "order").otherwise(F.get_json_object("value", "$.status"))
    return both.groupBy("topic", "partition", branch.alias("branch")).agg(
        F.count("*").alias("records"), F.max("offset").alias("last_offset"))


@query("json_stream_orders", """
    SELECT part AS "partition", pos AS "offset",
           CASE WHEN ok THEN order_id END AS order_id, CASE WHEN ok THEN customer_id END AS customer_id,
           CASE WHEN ok THEN round(total, 2) END AS total, CASE WHEN ok THEN 'created' END AS status,
           CASE WHEN ok THEN coalesce(n, 0) END AS n_items, CASE WHEN ok THEN CAST(coalesce(q, 0) AS BIGINT) END AS qty
    FROM (SELECT *, order_no % 89 <> 0 AS ok FROM f_log_orders WHERE order_no % 97 <> 0)
    LEFT JOIN (SELECT order_no, count(*) AS n, sum(qty) AS q FROM f_items GROUP BY order_no) USING (order_no)""",
       ("f_log_orders", "f_items"))
def json_stream_orders(spark: SparkSession, sf: str) -> DataFrame:
    read = declare(D.dirty(D.log_orders(spark, sf)), S.ORDER, keep=("partition", "offset"))
    return read.select(
        "partition", "offset", F.col("orderId").alias("order_id"), F.col("customerId").alias("customer_id"),
        F.round("total", 2).alias("total"), "status",
        F.when(F.col("items").isNotNull(), F.size("items")).cast("bigint").alias("n_items"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda a, i: a + i["qty"]).alias("qty"))


def _versioned(spark: SparkSession, sf: str) -> DataFrame:
    """Odd orders were written with schema 2, which added a discount code."""
    n = D.order_no("key")
    code = F.when(n % 4 == 1, F.lit('"SUMMER10"')).otherwise(F.lit("null"))
    v2 = F.concat(F.expr("substr(value, 1, length(value) - 1)"), F.lit(',"discountCode":'), code, F.lit("}"))
    return D.log_orders(spark, sf).select(
        (n % 2 + 1).cast("int").alias("schema_id"), F.when(n % 2 == 1, v2).otherwise(F.col("value")).alias("value"))


@query("schema_versions_union", """
    SELECT CAST(order_no % 2 + 1 AS INTEGER) AS schema_id, order_id, round(total, 2) AS total,
           CASE WHEN order_no % 4 = 1 THEN 'SUMMER10' END AS discount_code
    FROM f_orders""", ("f_orders",))
def schema_versions_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_versions(_versioned(spark, sf), {1: S.ORDER_V1, 2: S.ORDER_V2})
    return rows.select("schema_id", F.col("orderId").alias("order_id"), F.round("total", 2).alias("total"),
                       F.col("discountCode").alias("discount_code"))


@query("wire_header", """
    SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN doc_id % 3 + 70000 END AS schema_id,
           CASE WHEN doc_id % 13 <> 0 THEN CAST(strlen(text) AS BIGINT) END AS payload_bytes
    FROM documents""")
def wire_header_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    magic = F.when(F.col("doc_id") % 13 != 0, F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("01")))
    sid = F.unhex(F.lpad(F.hex(F.col("doc_id") % 3 + 70_000), 8, "0"))
    framed = d.select("doc_id", F.concat(magic, sid, F.encode("text", "utf-8")).alias("body"))
    return wire_header(framed).select(
        "doc_id", "schema_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"))


FRAMED_V1 = S.T.StructType().add("orderId", "string", False).add("customerId", "string").add("total", "integer")
FRAMED_V2 = S.T.StructType().add("orderId", "string", False).add("customer", "string").add("total", "double").add("discountCode", "string")
FRAMED_READER = S.T.StructType().add("orderId", "string", False).add("customer", "string").add("total", "double").add("discountCode", "string").add("channel", "string", False)


@query("framed_versions", """
    SELECT order_no, CASE WHEN order_no % 97 <> 0 THEN CASE WHEN order_no % 89 = 0 THEN 79 WHEN order_no % 2 = 0 THEN 71 ELSE 72 END END AS schema_id, reason AS reject_reason,
           CASE WHEN reason IS NULL THEN order_id END AS order_id, CASE WHEN reason IS NULL THEN customer_id END AS customer,
           CASE WHEN reason IS NULL THEN CASE WHEN order_no % 2 = 0 THEN floor(total) ELSE round(total, 2) END END AS total,
           CASE WHEN reason IS NULL THEN CASE WHEN order_no % 2 = 0 THEN 'NONE' WHEN order_no % 4 = 1 THEN 'SUMMER10' END END AS discount_code,
           CASE WHEN reason IS NULL THEN 'web' END AS channel
    FROM (SELECT *, CASE WHEN order_no % 97 = 0 THEN 'not framed' WHEN order_no % 89 = 0 THEN 'unknown schema' WHEN order_no % 83 = 0 THEN 'not JSON'
                         WHEN order_no % 73 = 0 THEN 'misfit: orderId' WHEN order_no % 79 = 0 THEN 'misfit: total' END AS reason FROM f_orders)""", ("f_orders",))
def framed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Framed orders of two schemas, read as the newest: a renamed field, a promoted type, two defaults, five kinds of rejects."""
    n = F.col("order_no")
    oid = F.when(n % 73 != 0, F.col("order_id")).alias("orderId")
    odd_total = F.lit("much").alias("total")
    v1, v2 = F.floor("total").cast("int").alias("total"), F.round("total", 2).alias("total")
    old = lambda total: F.to_json(F.struct(oid, F.col("customer_id").alias("customerId"), total))
    new = lambda total: F.to_json(F.struct(oid, F.col("customer_id").alias("customer"), total, F.when(n % 4 == 1, F.lit("SUMMER10")).alias("discountCode")))
    even = n % 2 == 0
    text = F.when(n % 83 == 0, F.lit("heyyy")).when(n % 79 == 0, F.when(even, old(odd_total)).otherwise(new(odd_total))).otherwise(F.when(even, old(v1)).otherwise(new(v2)))
    sid = F.when(n % 89 == 0, F.lit(79)).when(even, F.lit(71)).otherwise(F.lit(72))
    magic = F.when(n % 97 == 0, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    frames = D.orders(spark, sf).select("order_no", F.concat(magic, F.unhex(F.lpad(F.hex(sid), 8, "0")), F.encode(text, "utf-8")).alias("body"))
    writers = {71: Writer(FRAMED_V1, {"customer": "customerId"}), 72: Writer(FRAMED_V2)}
    read = read_framed(frames, writers, FRAMED_READER, {"discountCode": F.lit("NONE"), "channel": F.lit("web")})
    return read.select("order_no", F.col("schema_id").cast("int").alias("schema_id"), "reject_reason", F.col("orderId").alias("order_id"), "customer",
                       "total", F.col("discountCode").alias("discount_code"), "channel")


@query("incremental_read", """
    SELECT CASE WHEN o_orderkey <= m.half THEN 1 ELSE 2 END AS poll, o_orderkey, round(o_totalprice, 2) AS total
    FROM orders, (SELECT max(o_orderkey) // 2 AS half FROM orders) m""")
def incremental_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two polls: the table as it was when half of its ids existed, then the rows above that mark."""
    o = table(spark, sf, "orders").select("o_orderkey", F.round("o_totalprice", 2).alias("total"))
    mark = o.agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    first = incremental_read(o, "o_orderkey", None).filter(F.col("o_orderkey") <= mark)
    second = incremental_read(o, "o_orderkey", mark)
    return first.select(F.lit(1).alias("poll"), "*").unionByName(second.select(F.lit(2).alias("poll"), "*"))


@query("incremental_stream", """
    , mark AS (SELECT o_orderdate AS d FROM orders ORDER BY o_orderkey LIMIT 1)
    SELECT CASE WHEN o_orderdate < d OR (o_orderdate = d AND o_orderkey % 3 <> 0) THEN 0 ELSE 1 END AS poll, o_orderkey,
           round(o_totalprice, 2) AS total
    FROM orders, mark WHERE o_orderdate IS NOT NULL""", ("f_orders",))
def incremental_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The orders by date, a cursor that many rows share, polled by a process that ends after each poll.

    At the first poll the table ends at one date, of which every third order is missing; these come later, with the dates
    behind it.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    d = F.lit(o.orderBy("o_orderkey").first().o_orderdate)
    early = o.filter((F.col("o_orderdate") < d) | (F.col("o_orderdate") == d) & (F.col("o_orderkey") % 3 != 0))
    root = scratch_path(spark, "polls")
    for poll, there in enumerate((early, o, o)):
        Polling(spark, root, lambda there=there: there, "o_orderdate", "o_orderkey").poll(None, poll)
    got = Polling(spark, root, lambda: o, "o_orderdate", "o_orderkey").rows()
    return got.select(F.col("batch_id").cast("int").alias("poll"), "o_orderkey", F.round("o_totalprice", 2).alias("total"))


@query("tail_lines", """
    SELECT doc_id, strlen(line) AS line_bytes, sha256(line) AS line_sha256
    FROM (SELECT doc_id, doc_id || chr(9) || regexp_replace(coalesce(text, ''), '[\n\r]', ' ', 'g') AS line FROM documents)""")
def tail_lines_query(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as lines of files, taken by a stream that ends and starts again after more files were written."""
    d = table(spark, sf, "documents")
    line = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), F.regexp_replace(F.coalesce("text", F.lit("")), "[\n\r]", " "))
    lines, root = d.select("doc_id", line.alias("value")), scratch_path(spark, "lines")
    for half in range(2):
        lines.filter(F.coalesce(F.pmod("doc_id", F.lit(2)), F.lit(0)) == half).select("value").write.mode("append").text(f"{root}/files")
        drain(tail_lines(spark, f"{root}/files", pathGlobFilter="*.txt"), f"{root}/table", f"{root}/checkpoint")
    got = spark.read.schema(LINES).parquet(f"{root}/table")
    return got.select(F.substring_index("line", "\t", 1).cast("bigint").alias("doc_id"), F.octet_length("line").cast("bigint").alias("line_bytes"),
                      F.sha2("line", 256).alias("line_sha256"))


@query("raw_landing", """
    SELECT 'documents' AS topic, CAST(doc_id % 4 AS INTEGER) AS "partition", doc_id // 4 AS "offset",
           CAST(strlen(text) AS BIGINT) AS raw_bytes, sha256(text) AS raw_sha256
    FROM documents""")
def raw_landing_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(
        F.lit("documents").alias("topic"), (F.col("doc_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("doc_id") / 4).alias("offset"), F.col("text").alias("value"))
    return raw_landing(d).select("topic", "partition", "offset", "raw_bytes", F.sha2("raw", 256).alias("raw_sha256"))


@query("continuous_ingest", """
    SELECT event_id, event_type, make_timestamp(event_time * 1000) AS event_time,
           strftime(make_timestamp(event_time * 1000), '%Y-%m-%d') AS event_date, product_id, category, country,
           round(amount, 2) AS amount
    FROM f_events""", ("f_events",))
def continuous_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream into the typed table, run until it is drained."""
    out = ingest_events(spark, f"{sf}/events*.parquet", table(spark, sf, "events").schema, scratch_path(spark, "ingest"))
    return out.select("event_id", "event_type", "event_time", F.col("event_date").cast("string").alias("event_date"), "product_id", "category", "country",
                      F.round("amount", 2).alias("amount"))


@query("error_budget", """
    SELECT part AS "partition", pos // 1000 AS block, count(*) AS records,
           count(*) FILTER (WHERE order_no % 97 = 0) AS bad_records,
           count(*) FILTER (WHERE order_no % 97 = 0) <= 10 AS within_budget
    FROM f_log_orders GROUP BY ALL""", ("f_log_orders",))
def error_budget_query(spark: SparkSession, sf: str) -> DataFrame:
    log = with_reject_reason(D.dirty(D.log_orders(spark, sf)).select("partition", "offset", "value"))
    block = F.struct("partition", F.floor(F.col("offset") / 1000).alias("no"))
    blocks = block_errors(log, F.col("reject_reason").isNotNull(), block, 10)
    return blocks.select("block.partition", F.col("block.no").alias("block"), "records", "bad_records", "within_budget")


@query("publish_envelope", """
    SELECT order_id AS key, 'payments' AS topic, part AS "partition", pos AS "offset", event_at AS "timestamp",
           round(amount, 2) AS amount, status
    FROM f_log_payments""", ("f_log_payments",))
def publish_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return D.log_payments(spark, sf).select(
        "key", "topic", "partition", "offset", "timestamp",
        F.round(F.get_json_object("value", "$.amount").cast("double"), 2).alias("amount"),
        F.get_json_object("value", "$.status").alias("status"))


@query("file_sink_quarantine", """
    SELECT CASE WHEN order_no % 97 = 0 THEN 'quarantine' ELSE 'file' END AS sink,
           CASE WHEN order_no % 97 = 0 THEN 'invalid_json' END AS reason, count(*) AS records
    FROM f_orders GROUP BY ALL""", ("f_orders",))
def file_sink_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    path, log = scratch_path(spark, "file-sink"), D.dirty(D.log_orders(spark, sf))
    write_sorted_out(log, path)
    lines = read_sink_lines(spark, path).agg(F.count("*").alias("records")).select(
        F.lit("file").alias("sink"), F.lit(None).cast("string").alias("reason"), "records")
    held = read_quarantine(spark, path, log.schema).groupBy(F.col("reject_reason").alias("reason")).agg(F.count("*").alias("records"))
    return lines.unionByName(held.select(F.lit("quarantine").alias("sink"), "reason", "records"))


@query("schema_gate_rows", """
    SELECT order_no, CASE WHEN order_no % 89 = 0 THEN 'orderId' WHEN order_no % 97 = 0 THEN 'total' END AS misfit,
           CASE WHEN order_no % 97 <> 0 AND order_no % 89 <> 0 THEN round(total, 2) END AS total
    FROM f_orders""", ("f_orders",))
def schema_gate_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows offered as text to a typed table: some totals are not numbers, some ids are missing."""
    n = F.col("order_no")
    offered = D.orders(spark, sf).select(
        "order_no", F.when(n % 89 != 0, F.col("order_id")).alias("id_text"),
        F.when(n % 97 == 0, F.lit("heyyy")).otherwise(F.col("total").cast("string")).alias("total_text"))
    schema = S.T.StructType([
        S.T.StructField("order_no", S.T.LongType(), False), S.T.StructField("orderId", S.T.StringType(), False),
        S.T.StructField("total", S.T.DoubleType(), True)])
    columns = {"order_no": n.cast("string"), "orderId": F.col("id_text"), "total": F.col("total_text")}
    good, bad = gate_rows(offered, columns, schema)
    return good.select("order_no", F.lit(None).cast("string").alias("misfit"), F.round("total", 2).alias("total")).unionByName(
        bad.select("order_no", "misfit", F.lit(None).cast("double").alias("total")))


@query("clustered_table", """
    SELECT strftime(make_timestamp(event_time * 1000), '%Y%m') AS event_month, category, event_type,
           count(*) AS records, round(sum(amount), 2) AS revenue
    FROM f_events GROUP BY ALL""", ("f_events",))
def clustered_table(spark: SparkSession, sf: str) -> DataFrame:
    at = F.timestamp_millis("event_time")
    path = scratch_path(spark, "clustered")
    write_clustered(D.analytics_events(spark, sf).withColumn("event_month", F.date_format(at, "yyyyMM")), path,
                    "event_month", ["category", "event_type", "event_time"])
    return spark.read.parquet(path).groupBy(F.col("event_month").cast("string").alias("event_month"), "category", "event_type").agg(
        F.count("*").alias("records"), F.round(F.sum("amount"), 2).alias("revenue"))


@query("outbox_relay", """
    SELECT aggregatetype AS topic, aggregateid AS key, type AS event_type, id AS event_id,
           '00-' || trace_id || '-' || span_id || '-01' AS traceparent
    FROM f_outbox""", ("f_outbox",))
def outbox_relay(spark: SparkSession, sf: str) -> DataFrame:
    """Records as published by the relay; the trace context comes out of the payload, as a consumer takes it."""
    records = with_payload(relayed(D.published_events(spark, sf)), "type string")
    context = carried_first(F.col("headers"), F.col("payload.traceContext.traceparent"))
    return records.select("topic", "key", F.col("payload.type").alias("event_type"), F.element_at("headers", "id").alias("event_id"),
                          context.alias("traceparent"))


@query("outbox_rows", """
    SELECT id, aggregatetype, aggregateid, type, ts AS created_at FROM f_outbox""", ("f_outbox",))
def outbox_rows_query(spark: SparkSession, sf: str) -> DataFrame:
    """All six event types of the four services; an order sent twice has two events of each type, with ids of their own."""
    return D.published_events(spark, sf).select("id", "aggregatetype", "aggregateid", "type", "created_at")


@query("published_trace", """
    SELECT trace_id, span_id, parent_span_id, name, type AS event_type, split_part(name, '.', 1) || '-service' AS service
    FROM f_outbox""", ("f_outbox",))
def published_trace(spark: SparkSession, sf: str) -> DataFrame:
    return published_spans(relayed(D.published_events(spark, sf)))


@query("dlq_records", """
    SELECT 'orders' AS original_topic, part AS original_partition, pos AS original_offset, order_id,
           'downstream rejected ' || order_id || ' (attempt 3) — simulated permanent outage' AS failure_reason,
           3 AS attempts, ts AS failed_at, round(total, 2) AS total
    FROM f_log_orders WHERE scenario = 'permanent-fail'""", ("f_log_orders",))
def dlq_records(spark: SparkSession, sf: str) -> DataFrame:
    return dead_letters(D.log_orders(spark, sf)).select(
        "original_topic", "original_partition", "original_offset", "order_id", "failure_reason", "attempts", "failed_at",
        F.round(F.get_json_object("order", "$.total").cast("double"), 2).alias("total"))


@query("codec_footprint")
def codec_footprint_query(spark: SparkSession, sf: str) -> DataFrame:
    return codec_footprint(table(spark, sf, "events"), scratch_path(spark, "codecs"))


@query("codec_roundtrip", """
    SELECT codec, count(*) AS records, count(DISTINCT event_id) AS event_ids, round(sum(value), 2) AS total, codec <> 'none' AS smaller
    FROM events, (SELECT unnest(['none', 'gzip', 'zstd']) AS codec) GROUP BY codec""")
def codec_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """What comes back from the files of each codec, and whether they are smaller than those without one."""
    path, events = scratch_path(spark, "codecs"), table(spark, sf, "events")
    codecs = ("none", "gzip", "zstd")
    sizes = codec_footprint(events, path, codecs)
    back = spark.read.schema(T.StructType([*events.schema.fields, T.StructField("codec", T.StringType())])).parquet(path)
    sums = back.groupBy("codec").agg(F.count("*").alias("records"), F.countDistinct("event_id").alias("event_ids"), F.round(F.sum("value"), 2).alias("total"))
    return sums.join(sizes, "codec").select("codec", "records", "event_ids", "total", (F.col("ratio") > 1).alias("smaller"))


@query("claim_check_references", """
    SELECT 'attachments/' || doc_id AS key, 'event-' || doc_id AS event_id, 'payloads' AS bucket, CAST(strlen(text) AS BIGINT) AS size_bytes,
           sha256(text) AS checksum, 'text/plain' AS content_type, CAST(strlen(text) AS BIGINT) AS blob_bytes
    FROM documents WHERE strlen(text) > 2000""")
def claim_check_references(spark: SparkSession, sf: str) -> DataFrame:
    """The references that stay in the log, read back from their JSON, beside the blobs that left it."""
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("attachments/"), F.col("doc_id").cast("string")).alias("key"), "text", F.concat(F.lit("event-"), F.col("doc_id").cast("string")).alias("event"))
    parts = offload(d, "key", "text", F.col("event"), "payloads", "text/plain", max_bytes=2000)
    refs = declare(parts["references"], S.ATTACHMENT, keep=())
    blobs = digest(parts["blobs"]).select("key", F.col("actual_bytes").alias("blob_bytes"))
    return refs.join(blobs, "key").select("key", F.col("eventId").alias("event_id"), "bucket", F.col("sizeBytes").alias("size_bytes"), "checksum",
                                          F.col("contentType").alias("content_type"), "blob_bytes")


@query("claim_check_offload", """
    SELECT 'attachments/' || doc_id AS key, CASE WHEN strlen(text) > 2000 THEN 'reference' ELSE 'inline' END AS kind,
           CAST(strlen(text) AS BIGINT) AS bytes, CASE WHEN strlen(text) > 2000 THEN sha256(text) END AS checksum
    FROM documents""")
def claim_check_offload(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("attachments/"), F.col("doc_id").cast("string")).alias("key"), "text")
    return classify(d, "text", max_bytes=2000).select("key", "kind", "bytes", "checksum")
