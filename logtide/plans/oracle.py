"""DuckDB side of the derived views: common table expressions shared by the oracles.

Written from the rules of the views, not from the Spark code: window functions instead of
range-split numbering, plain joins instead of bucketed ones, columns instead of JSON text.
"""

from __future__ import annotations

_MULT = "1540483477"
_LOW = "4294967295"


def _bind(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def murmur2(key: str) -> str:
    """DuckDB expression: unsigned murmur2 of an ASCII text."""
    def byte(pos: str) -> str:
        return f"CAST(ascii(substr({key}, CAST({pos} AS BIGINT), 1)) AS BIGINT)"

    def times(x: str) -> str:
        return f"((({x}) * {_MULT}) & {_LOW})"

    size = f"strlen({key})"
    word = f"({byte('i*4+1')} + {byte('i*4+2')} * 256 + {byte('i*4+3')} * 65536 + {byte('i*4+4')} * 16777216)"
    words = f"list_transform(range({size} // 4), lambda i: {word})"
    first = f"list_transform({words}, lambda w: {times('w')})"
    mixed = f"list_transform({first}, lambda k: {times('xor(k, k >> 24)')})"
    body = f"list_reduce({mixed}, lambda h, k: xor({times('h')}, k), xor(2538058380::BIGINT, {size}::BIGINT))"
    at = f"({size} // 4 * 4)"
    rest = f"({size} % 4)"
    tail = (
        f"({byte(at + '+1')} + CASE WHEN {rest} > 1 THEN {byte(at + '+2')} * 256 ELSE 0 END"
        f" + CASE WHEN {rest} > 2 THEN {byte(at + '+3')} * 65536 ELSE 0 END)")
    tailed = _bind(body, "g", f"CASE WHEN {rest} > 0 THEN {times(f'xor(g, {tail})')} ELSE g END")
    return _bind(_bind(tailed, "m", times("xor(m, m >> 13)")), "z", "xor(z, z >> 15)")


def partition(key: str, n: int) -> str:
    return f"CAST(({murmur2(key)} & 2147483647) % {n} AS INTEGER)"


VIEWS: dict[str, str] = {
    "f_orders": """
        SELECT o_orderkey AS order_no,
               'order-' || (['happy', 'payment-declined', 'out-of-stock', 'transient-fail-3', 'permanent-fail']
                           )[CAST(o_orderkey % 5 AS INTEGER) + 1] || '-' || o_orderkey AS order_id,
               ['happy', 'payment-declined', 'out-of-stock', 'transient-fail', 'permanent-fail'
                           ][CAST(o_orderkey % 5 AS INTEGER) + 1] AS scenario,
               'cust-' || o_custkey AS customer_id, o_totalprice AS total,
               CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS ts
        FROM orders""",
    "f_items": """
        SELECT l_orderkey AS order_no, 'sku-' || l_partkey AS sku, CAST(l_quantity AS INTEGER) AS qty
        FROM lineitem""",
    "f_log_orders": f"""
        SELECT order_no, order_id, scenario, customer_id, total, ts, part,
               row_number() OVER (PARTITION BY part ORDER BY ts, order_no) - 1 AS pos
        FROM (SELECT *, {partition('order_id', 3)} AS part FROM f_orders)""",
    "f_payments": """
        SELECT order_no, order_id, scenario, customer_id, total AS amount, ts AS order_ts,
               CASE WHEN scenario IN ('payment-declined', 'permanent-fail') THEN 'failed' ELSE 'succeeded' END AS status,
               CASE WHEN scenario IN ('transient-fail', 'permanent-fail') THEN 3 ELSE 1 END AS attempts,
               ts + to_seconds(CAST(order_no * 37 % 10800 AS BIGINT)) AS paid_at
        FROM f_orders""",
    "f_payment_events": """
        SELECT order_no, order_id, amount, status, attempts, paid_at AS event_at, 0 AS kind FROM f_payments
        UNION ALL
        SELECT order_no, order_id, NULL, 'refunded', NULL, paid_at + INTERVAL 60 SECONDS, 1
        FROM f_payments WHERE scenario = 'out-of-stock'""",
    "f_log_payments": f"""
        SELECT *, row_number() OVER (PARTITION BY part ORDER BY event_at, kind, order_no) - 1 AS pos
        FROM (SELECT *, {partition('order_id', 3)} AS part FROM f_payment_events)""",
    "f_published": """
        SELECT *, sha256('orders/' || order_id || '/OrderCreated/orders/' || part || '/' || pos) AS order_event,
               md5('trace/' || order_id || '/orders/' || part || '/' || pos) AS trace_id,
               substr(md5(md5('trace/' || order_id || '/orders/' || part || '/' || pos) || '/order.create'), 1, 16) AS s0
        FROM (SELECT order_id, scenario, part, pos, ts, total FROM f_log_orders UNION ALL
              SELECT order_id, scenario, part, pos + 1000000000000, ts + INTERVAL 1 DAY, total FROM f_log_orders WHERE pos % 5 = 0)""",
    "f_hops": """
        SELECT *, substr(md5(s2 || '/payment.compensate'), 1, 16) AS s3c, substr(md5(s2 || '/shipping.create'), 1, 16) AS s3s,
               sha256('inventory/' || order_id || '/InventoryReserved/' || paid_event) AS reserved_event,
               sha256('payment-compensation/' || order_id || '/CompensationRequested/' || paid_event) AS asked_event
        FROM (SELECT *, substr(md5(s1 || '/inventory.reserve'), 1, 16) AS s2,
                     sha256('payments/' || order_id || '/' || paid_type || '/' || order_event) AS paid_event
              FROM (SELECT *, substr(md5(s0 || '/payment.process'), 1, 16) AS s1,
                           CASE WHEN scenario IN ('payment-declined', 'permanent-fail') THEN 'PaymentFailed' ELSE 'PaymentSucceeded' END AS paid_type
                    FROM f_published))""",
    "f_outbox": """
        SELECT order_event AS id, 'orders' AS aggregatetype, order_id AS aggregateid, 'OrderCreated' AS type, trace_id, s0 AS span_id,
               NULL AS parent_span_id, 'order.create' AS name, ts FROM f_hops
        UNION ALL SELECT paid_event, 'payments', order_id, paid_type, trace_id, s1, s0, 'payment.process', ts FROM f_hops
        UNION ALL SELECT reserved_event, 'inventory', order_id, 'InventoryReserved', trace_id, s2, s1, 'inventory.reserve', ts FROM f_hops
                  WHERE paid_type = 'PaymentSucceeded' AND scenario <> 'out-of-stock'
        UNION ALL SELECT asked_event, 'payment-compensation', order_id, 'CompensationRequested', trace_id, s2, s1, 'inventory.reserve', ts
                  FROM f_hops WHERE scenario = 'out-of-stock'
        UNION ALL SELECT sha256('payments/' || order_id || '/PaymentRefunded/' || asked_event), 'payments', order_id, 'PaymentRefunded',
                         trace_id, s3c, s2, 'payment.compensate', ts FROM f_hops WHERE scenario = 'out-of-stock'
        UNION ALL SELECT sha256('shipping/' || order_id || '/ShipmentCreated/' || reserved_event), 'shipping', order_id, 'ShipmentCreated',
                         trace_id, s3s, s2, 'shipping.create', ts FROM f_hops
                  WHERE paid_type = 'PaymentSucceeded' AND scenario <> 'out-of-stock'""",
    "f_deliveries": """
        SELECT *, 1 AS seq FROM f_log_orders
        UNION ALL
        SELECT *, 2 AS seq FROM f_log_orders WHERE pos % 10 = 3""",
    "f_events": """
        SELECT event_id, epoch_us(ts) // 1000 AS event_time,
               CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
               CAST(user_id AS VARCHAR) AS user_id, 'prod-' || event_id % 200 AS product_id,
               'cat-' || event_id % 6 AS category, 'c' || user_id % 8 AS country,
               CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS amount
        FROM events""",
    "f_skewed": """
        SELECT event_id, ts, value,
               CASE WHEN event_id % 5 <> 0 THEN 'customer-VIP' ELSE 'customer-' || user_id END AS key
        FROM events""",
    "f_skewed_placed": f"""
        SELECT s.*, p.part FROM f_skewed s JOIN
        (SELECT key, {partition('key', 6)} AS part FROM (SELECT DISTINCT key FROM f_skewed)) p USING (key)""",
    "f_refs": """
        SELECT doc_id, 'event-' || doc_id AS event_id, 'attachments/' || doc_id AS key,
               CAST(strlen(text) AS BIGINT) AS size_bytes, sha256(text) AS true_sha,
               CASE WHEN doc_id % 50 = 0 THEN reverse(sha256(text)) ELSE sha256(text) END AS checksum
        FROM documents""",
    "f_log_ends": """
        SELECT part, max(pos) + 1 AS log_end FROM f_log_orders GROUP BY part""",
    "f_offsets": """
        SELECT g.name AS consumer_group, part, log_end, CAST(log_end * g.tenths // 10 AS BIGINT) AS committed
        FROM f_log_ends, (VALUES ('payment-service', 9), ('inventory-service', 5)) g(name, tenths)""",
    "f_metrics": """
        SELECT event_type, make_timestamp(minute * 60000000) AS ts,
               CAST(sum(n) OVER (PARTITION BY event_type, minute // 1000 ORDER BY minute) AS DOUBLE) AS value
        FROM (SELECT event_type, CAST(floor(epoch(ts) / 60) AS BIGINT) AS minute, count(*) AS n
              FROM events GROUP BY ALL)""",
    "f_deltas": """
        SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS delta
        FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS before FROM f_metrics)""",
    "f_increase": """
        SELECT event_type, ts, value,
               sum(delta) OVER (PARTITION BY event_type ORDER BY ts
                                RANGE BETWEEN INTERVAL 299999999 MICROSECONDS PRECEDING AND CURRENT ROW) AS increase
        FROM f_deltas""",
    "f_all_spans": """
        SELECT order_no, hop, 'trace-' || order_id AS trace_id, order_id || '/' || hop AS span_id,
               CASE WHEN hop > 0 THEN order_id || '/' || (hop - 1) END AS parent_span_id, name,
               ts + to_seconds(CAST(hop * 2 + CASE WHEN hop > 2 THEN order_no % 7 ELSE 0 END AS BIGINT)) AS start_at
        FROM f_orders JOIN (VALUES
            ('happy', 3, 'shipping.create'), ('transient-fail', 3, 'shipping.create'), ('out-of-stock', 3, 'payment.compensate'),
            ('out-of-stock', 4, 'inventory.reserve'), (NULL, 0, 'order.create'), (NULL, 1, 'payment.process'),
            (NULL, 2, 'inventory.reserve')) h(only_for, hop, name) ON only_for IS NULL OR only_for = scenario
        WHERE NOT (order_no % 200 = 0 AND hop = 0)""",
}

_NEEDS = {
    "f_log_orders": ["f_orders"], "f_payments": ["f_orders"], "f_payment_events": ["f_payments"],
    "f_log_payments": ["f_payment_events"], "f_published": ["f_log_orders"], "f_hops": ["f_published"], "f_outbox": ["f_hops"], "f_deliveries": ["f_log_orders"], "f_skewed_placed": ["f_skewed"],
    "f_log_ends": ["f_log_orders"], "f_offsets": ["f_log_ends"], "f_deltas": ["f_metrics"],
    "f_increase": ["f_deltas"], "f_all_spans": ["f_orders"],
}


def with_views(sql: str, *views: str) -> str:
    """``sql`` preceded by the views it uses and the views those use."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for v in views:
        add(v)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
    return f"WITH {ctes}\n{sql.strip()}"
