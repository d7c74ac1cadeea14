"""W3C trace context carried in message headers or inside the payload."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TRACEPARENT_PATTERN = r"^00-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"


def traceparent(trace_id: Column, span_id: Column) -> Column:
    return F.concat_ws("-", F.lit("00"), trace_id, span_id, F.lit("01"))


def inject(headers: Column, trace_id: Column, span_id: Column) -> Column:
    """Headers with the trace context added; an older context is replaced."""
    kept = F.map_filter(F.coalesce(headers, F.create_map().cast("map<string,string>")),
                        lambda k, _: k != F.lit("traceparent"))
    return F.map_concat(kept, F.create_map(F.lit("traceparent"), traceparent(trace_id, span_id)))


def carried(headers: Column, payload: Column) -> Column:
    """The carried context: header first, then the payload's ``traceContext`` field."""
    return carried_first(headers, F.get_json_object(payload, "$.traceContext.traceparent"))


def carried_first(headers: Column, in_payload: Column) -> Column:
    """The same for a payload that is parsed already: the header's context, else ``in_payload``."""
    return F.coalesce(F.try_element_at(headers, F.lit("traceparent")), in_payload)


def _trace_of(context: Column) -> Column:
    """The trace id of a well-formed context, whose fields have fixed places."""
    return F.substring(context, 4, 32)


def _span_of(context: Column) -> Column:
    return F.substring(context, 37, 16)


def parent_of(context: Column) -> Column:
    """struct(trace_id, parent_span_id) of a context; null when missing or malformed."""
    return F.when(
        context.rlike(TRACEPARENT_PATTERN),
        F.struct(_trace_of(context).alias("trace_id"), _span_of(context).alias("parent_span_id")),
    )


def root_of(seed: Column, hop: Column) -> Column:
    """Context of the first span of a new trace: trace and span ids are derived from ``seed``, so a replay repeats them."""
    trace = F.md5(F.concat_ws("/", F.lit("trace"), seed))
    return traceparent(trace, F.substring(F.md5(F.concat_ws("/", trace, hop)), 1, 16))


def child_of(context: Column, hop: Column) -> Column:
    """Context of the work ``hop`` that a carried context caused: the same trace, a span id derived from (parent, hop).

    Null where no usable context was carried; the caller opens a trace of its own then.
    """
    span = F.substring(F.md5(F.concat_ws("/", _span_of(context), hop)), 1, 16)
    return F.when(context.rlike(TRACEPARENT_PATTERN), traceparent(_trace_of(context), span))
