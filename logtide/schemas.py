"""Record envelope and entity schemas.

Every log table has the envelope columns, whatever its source is; the values are
JSON text, declared on read by one of the entity schemas below.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ENVELOPE = _struct(
    ("key", _S), ("value", _S), ("topic", _S), ("partition", _I), ("offset", _L),
    ("timestamp", _TS), ("headers", T.MapType(_S, _S)),
)

ITEMS = T.ArrayType(_struct(("sku", _S), ("qty", _I)))

ORDER = _struct(("orderId", _S), ("customerId", _S), ("items", ITEMS), ("total", _D), ("status", _S))
PAYMENT = _struct(("orderId", _S), ("items", ITEMS), ("amount", _D), ("status", _S), ("processedAt", _S))
INVENTORY = _struct(("orderId", _S), ("items", ITEMS), ("reserved", _B), ("reservedAt", _S))
SHIPMENT = _struct(("orderId", _S), ("trackingId", _S), ("shippedAt", _S))
REFUND = _struct(("orderId", _S), ("reason", _S), ("status", _S), ("issuedAt", _S))
CLICK = _struct(("userId", _S), ("page", _S))
SESSION = _struct(("userId", _S), ("device", _S))
ANALYTICS_EVENT = _struct(
    ("event_id", _S), ("event_time", _L), ("event_type", _S), ("user_id", _S),
    ("product_id", _S), ("category", _S), ("country", _S), ("amount", _D),
)
ATTACHMENT = _struct(
    ("eventId", _S), ("bucket", _S), ("key", _S), ("sizeBytes", _L), ("checksum", _S), ("contentType", _S),
)

# Versions of the order value. A field that is not nullable here has no default
# and is therefore required of every writer.
ORDER_V1 = ORDER
ORDER_V2 = T.StructType(ORDER.fields + [T.StructField("discountCode", _S, True)])
ORDER_V3 = T.StructType(ORDER_V2.fields + [T.StructField("shippingAddress", _S, False)])
