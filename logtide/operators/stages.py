"""The order -> payment -> inventory -> shipping chain as projections, and its saga.

Each hop carries ``items`` forward, so no hop looks anything up. Compensation never
creates orders, so the chain is an acyclic set of projections without a feedback loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logtide.functions import rules as R
from logtide.operators.decode import with_reject_reason
from logtide.operators.retry import with_final_outcome


def to_payments(orders: DataFrame, at: str = "ts", with_retry: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """One payment per order: amount = total, items carried, status by rule.

    A declined order is a business answer and is never retried. With ``with_retry`` an
    order that exhausts its attempts also becomes a failed payment. ``extra`` columns are
    carried along.
    """
    declined = R.is_declined(F.col("order_id"))
    done = with_final_outcome(orders) if with_retry else orders.select(
        "*", F.lit(1).alias("attempts"), F.lit(False).alias("exhausted"))
    return done.select(
        "order_id", "items", F.col("total").alias("amount"),
        F.when(declined | F.col("exhausted"), "failed").otherwise("succeeded").alias("status"),
        F.when(declined, F.lit(1)).otherwise(F.col("attempts")).alias("attempts"),
        F.col(at).alias("processed_at"), *extra)


def _paid(payments: DataFrame) -> DataFrame:
    """Refund events share the topic: only fresh successful payments go on."""
    return payments.filter(F.col("status") == "succeeded")


def to_inventory(payments: DataFrame) -> DataFrame:
    return _paid(payments).filter(~R.is_out_of_stock(F.col("order_id"))).select(
        "order_id", "items", F.lit(True).alias("reserved"), F.col("processed_at").alias("reserved_at"))


def to_compensation(payments: DataFrame) -> DataFrame:
    return _paid(payments).filter(R.is_out_of_stock(F.col("order_id"))).select(
        "order_id", F.lit(R.OUT_OF_STOCK_REASON).alias("reason"), F.col("processed_at").alias("requested_at"))


def to_shipping(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "order_id", R.tracking_id(F.col("order_id"), F.col("reserved_at")).alias("tracking_id"),
        F.col("reserved_at").alias("shipped_at"))


def to_refunds(compensation: DataFrame) -> DataFrame:
    """One issued refund per order, the first request winning."""
    return compensation.groupBy("order_id").agg(
        F.min_by("reason", "requested_at").alias("reason"), F.min("requested_at").alias("issued_at"),
    ).select("order_id", "reason", F.lit("issued").alias("status"), "issued_at")


def refund_events(refunds: DataFrame) -> DataFrame:
    """Refunds as events of the payments topic; they carry no amount."""
    return refunds.select(
        "order_id", F.lit(None).cast("double").alias("amount"), F.lit("refunded").alias("status"),
        F.col("issued_at").alias("processed_at"))


def _step(step: str, detail: Column) -> Column:
    return F.struct(F.lit(step).alias("step"), detail.alias("detail"))


def orchestrated_audit(orders: DataFrame, at: str = "ts", gave_up: Column | None = None, shipped: Column | None = None) -> DataFrame:
    """Audit rows of the orchestrated saga: (order_id, seq, step, detail).

    ``gave_up`` marks orders whose payment used up its attempts, ``shipped`` those whose shipment is known; without them,
    no payment gives up and all is shipped. A saga that waits for its shipment has no end yet.
    """
    oid = F.col("order_id")
    declined = F.array(
        _step("payment", F.lit("failed")),
        _step("saga-ended", F.lit(R.DECLINED_OUTCOME)))
    out_of_stock = F.array(
        _step("payment", F.lit("succeeded")),
        _step("inventory", F.lit("out-of-stock")),
        _step("compensate-payment", F.lit(R.OUT_OF_STOCK_REASON)),
        _step("saga-ended", F.lit(R.COMPENSATED_OUTCOME)))
    happy = F.array(
        _step("payment", F.lit("succeeded")),
        _step("inventory", F.lit("reserved")),
        _step("shipment", R.tracking_id(oid, F.col(at))),
        _step("saga-ended", F.lit(R.COMPLETED_OUTCOME)))
    dead = F.array(
        _step("payment", F.lit("failed")),
        _step("saga-ended", F.lit(R.DEAD_LETTERED_OUTCOME)))
    reserved = happy if shipped is None else F.when(shipped, happy).otherwise(F.slice(happy, 1, 2))
    paid = F.when(R.is_out_of_stock(oid), out_of_stock).otherwise(reserved)
    steps = F.when(R.is_declined(oid), declined).otherwise(paid if gave_up is None else F.when(gave_up, dead).otherwise(paid))
    return orders.select("order_id", F.posexplode(steps).alias("seq", "s")).select("order_id", "seq", "s.step", "s.detail")


# Terminal states, from the strongest evidence to the weakest.
TERMINAL_STATES = ("completed", "compensated", "dead-lettered", "declined", "in-flight")


def terminal_states(events: DataFrame) -> DataFrame:
    """Terminal state per order from its events (order_id, topic, status)."""
    def saw(topic: str, status: str | None = None) -> Column:
        hit = F.col("topic") == topic
        return F.bool_or(hit if status is None else hit & (F.col("status") == status))

    seen = events.groupBy("order_id").agg(
        saw("shipping").alias("shipped"), saw("payments", "refunded").alias("refunded"),
        saw("payments-dlq").alias("dead"), saw("payments", "failed").alias("failed"))
    flags = ("shipped", "refunded", "dead", "failed")
    state = F.lit(TERMINAL_STATES[-1])
    for flag, name in reversed(list(zip(flags, TERMINAL_STATES))):
        state = F.when(F.col(flag), name).otherwise(state)
    return seen.select("order_id", state.alias("state"))


def orchestrated_states(audit: DataFrame) -> DataFrame:
    """Terminal state per order from the orchestrator's audit rows."""
    end = F.max(F.when(F.col("step") == "saga-ended", F.col("detail")))
    return audit.groupBy("order_id").agg(end.alias("_end")).select(
        "order_id",
        F.when(F.col("_end") == R.COMPLETED_OUTCOME, "completed")
        .when(F.col("_end") == R.COMPENSATED_OUTCOME, "compensated")
        .when(F.col("_end") == R.DECLINED_OUTCOME, "declined")
        .when(F.col("_end") == R.DEAD_LETTERED_OUTCOME, "dead-lettered")
        .otherwise("in-flight").alias("state"))


def state_agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both terminal states of every order that either side knows, and whether they agree."""
    l = left.select("order_id", F.col("state").alias("left_state"))
    r = right.select("order_id", F.col("state").alias("right_state"))
    return l.join(r, "order_id", "full_outer").withColumn("agree", F.col("left_state").eqNullSafe(F.col("right_state")))


def stage_latency(hops: DataFrame, stages: list[str]) -> DataFrame:
    """Delay of each stage per order: first event of the stage minus that of the nearest stage before that the order has.

    ``hops`` has (order_id, stage, ts). First times are plain aggregates, so repeated
    events of one order fold inside each task.
    """
    firsts = hops.groupBy("order_id").agg(
        *[F.min(F.when(F.col("stage") == s, F.col("ts"))).alias(f"_t{i}") for i, s in enumerate(stages)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("stage_no"), F.lit(s).alias("stage"), F.col(f"_t{i}").alias("ts"),
                 ((F.unix_micros(f"_t{i}") - F.unix_micros(F.coalesce(*[f"_t{k}" for k in range(i - 1, -1, -1)]))) / 1_000_000 if i else
                  F.lit(None).cast("double")).alias("delay_seconds"))
        for i, s in enumerate(stages)
    ])
    return firsts.select("order_id", F.inline(rows)).filter(F.col("ts").isNotNull())


def saga_story(steps: DataFrame) -> DataFrame:
    """Numbered story per order from (order_id, step, at, rank).

    Every event is told, repeated steps too; equal ones are counted before the story is put in order and told so often.
    """
    counted = steps.groupBy("order_id", "at", "rank", "step").agg(F.count("*").cast("int").alias("_n"))
    kinds = counted.groupBy("order_id").agg(F.sort_array(F.collect_list(F.struct("at", "rank", "step", "_n"))).alias("_k"))
    story = kinds.select("order_id", F.flatten(F.transform("_k", lambda e: F.array_repeat(e, e["_n"]))).alias("_s"))
    return story.select("order_id", F.posexplode("_s").alias("_p", "_e")).select(
        "order_id", (F.col("_p") + 1).alias("story_no"), "_e.step", "_e.at")


def stage_funnel(df: DataFrame, stages: list[tuple[str, Column, str | None]]) -> DataFrame:
    """(stage_no, stage, records, dropped, drop_reason) from one pass over the records.

    ``stages`` lists (stage, condition that a record reached it, why others did not);
    ``dropped`` counts against the stage before.
    """
    counts = df.agg(*[F.count_if(reached).alias(f"_n{i}") for i, (_, reached, _) in enumerate(stages)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"_n{i}").alias("records"),
                 (F.col(f"_n{i - 1}") - F.col(f"_n{i}") if i else F.lit(0).cast("bigint")).alias("dropped"),
                 F.lit(reason).cast("string").alias("drop_reason"))
        for i, (name, _, reason) in enumerate(stages)
    ])
    return counts.select(F.inline(rows))


def chain_funnel(log: DataFrame) -> DataFrame:
    """Funnel of an orders log through the chain; ``value`` holds the order JSON."""
    read = with_final_outcome(with_reject_reason(log.select("key", "value")), "key")
    oid, parsed = F.col("key"), F.col("reject_reason").isNull()
    paid = parsed & ~R.is_declined(oid) & ~F.col("exhausted")
    reserved = paid & ~R.is_out_of_stock(oid)
    return stage_funnel(read, [
        ("received", F.lit(True), None), ("parsed", parsed, "not JSON"), ("paid", paid, "payment failed"),
        ("reserved", reserved, "out of stock"), ("shipped", reserved, None)])
