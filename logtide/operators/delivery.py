"""Delivery guarantees over log DataFrames: dedup, ledger, outbox, audits, isolation.

A delivery is identified by (topic, partition, offset). Groups of copies are reduced by
an aggregate (which combines inside each task) and joined back where the copies are
needed, never ranked in one window group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logtide.operators.ordered import chunked_next_known, offset_chunk

DELIVERY = ["topic", "partition", "offset"]


def delivery_outcomes(batch: DataFrame, ledger: DataFrame | None = None, seq: str = "delivery_seq") -> DataFrame:
    """Tag each delivery ``applied`` or ``duplicate``.

    The earliest copy by ``seq`` (unique per copy) is applied unless the ledger already
    has its triple; every other copy is a duplicate.
    """
    firsts = batch.groupBy(*DELIVERY).agg(F.min(seq).alias("_first"))
    if ledger is not None:
        firsts = new_deliveries(firsts, ledger)
    return (
        batch.join(firsts, DELIVERY, "left")
        .withColumn("outcome", F.when(F.col(seq) == F.col("_first"), "applied").otherwise("duplicate"))
        .drop("_first")
    )


def new_deliveries(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose triple the ledger does not have (insert-if-absent)."""
    return batch.join(ledger.select(*DELIVERY), DELIVERY, "left_anti")


def distinct_deliveries(batch: DataFrame, seq: str) -> DataFrame:
    """One row per delivery triple: the copy with the lowest ``seq``."""
    rest = [c for c in batch.columns if c not in DELIVERY]
    # By offset first: the copies are sorted by their triple, and topic and partition rarely tell two of them apart.
    return (
        batch.groupBy(*reversed(DELIVERY)).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_r"))
        .select(*DELIVERY, "_r.*").select(*batch.columns)
    )


def effect_counts(deliveries: DataFrame, key: str, status: str, at: str, order: list[str]) -> DataFrame:
    """Upsert counter per key: status of the first effect, number of effects, first time."""
    return deliveries.groupBy(key).agg(
        F.min_by(status, F.struct(*order)).alias("status"),
        F.count("*").alias("effect_count"),
        F.min(at).alias("first_processed_at"),
    )


def payments_state(effects: DataFrame, order: list[str]) -> DataFrame:
    """Payment upsert: first amount is kept, status is the last one, attempts add up."""
    at = F.struct(*order)
    return effects.groupBy("order_id").agg(
        F.min_by("amount", at).alias("amount"),
        F.max_by("status", at).alias("status"),
        F.sum("attempts").alias("retry_attempts"),
    )


def first_write(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First-write-wins upsert: the earliest row of each key, whole."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def latest_by_offset(log: DataFrame, key: str, values: list[str], order: list[str]) -> DataFrame:
    """Latest non-null value of each column per key, each column on its own."""
    at = F.struct(*order)
    return log.groupBy(key).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values])


def business_duplicates(log: DataFrame) -> DataFrame:
    """Same key and same value at more than one offset: a report, nothing is dropped."""
    copies = log.groupBy("topic", "partition", "key", F.sha2("value", 256).alias("value_sha256")).agg(
        F.count("*").alias("copies"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    return copies.filter(F.col("first_offset") < F.col("last_offset"))


def lost_events(store: DataFrame, log: DataFrame, on: list[str]) -> DataFrame:
    """Rows in the store without an event in the log."""
    return store.join(log.select(*on), on, "left_anti")


def delivery_audit(log: DataFrame, effects: DataFrame) -> DataFrame:
    """Per logged delivery: number of effects and ``ok`` / ``lost`` / ``duplicate``.

    Log and effects are counted together, in one aggregate by delivery; effects of deliveries that are not in the log
    are left out.
    """
    rest = [c for c in log.columns if c not in DELIVERY]
    logged = log.select(*DELIVERY, F.struct(F.lit(True).alias("_logged"), *rest).alias("_row"))
    both = logged.unionByName(effects.select(*DELIVERY), allowMissingColumns=True)
    counted = both.groupBy(*DELIVERY).agg(
        F.first("_row", ignorenulls=True).alias("_row"), F.count_if(F.col("_row").isNull()).alias("effects"))
    n = F.col("effects")
    return counted.filter(F.col("_row").isNotNull()).select(
        *[F.col(c) if c in DELIVERY else F.col("_row").getField(c).alias(c) for c in log.columns], n,
        F.when(n == 0, "lost").when(n == 1, "ok").otherwise("duplicate").alias("verdict"))


def delivery_verdict(audit: DataFrame) -> DataFrame:
    """One row per topic: what the effects say about the delivery guarantee."""
    lost, dup = F.count_if(F.col("verdict") == "lost"), F.count_if(F.col("verdict") == "duplicate")
    return audit.groupBy("topic").agg(
        F.count("*").alias("logged"), F.sum("effects").alias("effects"),
        lost.alias("lost"), dup.alias("duplicated"),
        F.when((lost > 0) & (dup > 0), "neither")
        .when(lost > 0, "at-most-once").when(dup > 0, "at-least-once")
        .otherwise("exactly-once").alias("guarantee"))


def read_committed(log: DataFrame, producer: str = "producer_id", control: str = "control") -> DataFrame:
    """Data records of committed transactions, and those outside any transaction.

    Control records (``control`` = COMMIT or ABORT) take offsets in the log like data. A
    record of a transactional producer is closed by that producer's next control record
    in the partition; with none yet, its transaction is still open and it stays hidden.
    """
    closed = chunked_next_known(
        log, ["topic", "partition", producer], ["offset"], control, offset_chunk("offset"), "_closed_by")
    return closed.filter(
        F.col(control).isNull() & (F.col(producer).isNull() | (F.col("_closed_by") == "COMMIT"))
    ).select(*log.columns)


def read_uncommitted(log: DataFrame, control: str = "control") -> DataFrame:
    """All data records, including those of open and aborted transactions."""
    return log.filter(F.col(control).isNull())


def outbox_rows(events: DataFrame, aggregate_type: str, aggregate_id: str, event_type, payload,
                delivery: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Outbox rows for business events; the row id is derived, so a replay repeats it.

    ``delivery`` names the columns of the delivery that caused the event: an order sent again is another event with an id
    of its own. ``keep`` columns are carried along.
    """
    key = F.concat_ws("/", F.lit(aggregate_type), F.col(aggregate_id), event_type, *[F.col(c).cast("string") for c in delivery])
    return events.select(
        F.sha2(key, 256).alias("id"), F.lit(aggregate_type).alias("aggregatetype"),
        F.col(aggregate_id).alias("aggregateid"), event_type.alias("type"), payload.alias("payload"), *keep)


def relay(outbox: DataFrame, topic_template: str = "{aggregatetype}") -> DataFrame:
    """Route outbox rows: topic from the aggregate type, key from its id, value = payload.

    ``topic_template`` may use ``{aggregatetype}`` or ``{type}`` within other text.
    """
    topic = F.lit(topic_template)
    for field in ("aggregatetype", "type"):
        topic = F.replace(topic, F.lit("{" + field + "}"), F.col(field))
    return outbox.select(topic.alias("topic"), F.col("aggregateid").alias("key"), F.col("payload").alias("value"))


def reconcile(systems: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys that are not in every system, with the systems they are missing in.

    The systems' keys are tagged and counted together, in one aggregate by key. The label lists the missing systems in
    the given order.
    """
    tagged: DataFrame | None = None
    for name, df in systems.items():
        side = df.select(F.col(key).alias("key"), F.lit(name).alias("_system"))
        tagged = side if tagged is None else tagged.unionByName(side)
    counted = tagged.groupBy("key").agg(*[F.count_if(F.col("_system") == n).alias(f"in_{n}") for n in systems])
    missing = F.concat_ws(",", *[F.when(F.col(f"in_{n}") == 0, F.lit(n)) for n in systems])
    return counted.withColumn("missing_in", missing).filter(F.col("missing_in") != "")


def system_counts(systems: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of one labelled row count per system."""
    out: DataFrame | None = None
    for name, df in systems.items():
        row = df.agg(F.count("*").alias("records")).select(F.lit(name).alias("system"), "records")
        out = row if out is None else out.unionByName(row)
    return out


def batch_stats(commits: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Number of commit batches and their average, smallest and largest row counts."""
    sizes = commits.groupBy(batch).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("batches"), F.sum("n").alias("total_rows"), F.avg("n").alias("avg_rows"),
        F.min("n").alias("min_rows"), F.max("n").alias("max_rows"))


def outcome_counts(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """Applied and duplicate deliveries per group, with the applied ratio."""
    applied = F.count_if(F.col("outcome") == "applied")
    return outcomes.groupBy(*by).agg(
        F.count("*").alias("records"), applied.alias("applied"), (F.count("*") - applied).alias("duplicates"),
        (applied / F.count("*")).alias("applied_ratio"))
