"""Streams: same results as batch, restart, crash windows, replay, late data, bounded batches."""

import datetime as dt
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from logtide.operators import delivery as V, retry, stages
from logtide.operators.intervals import outside_ranges
from logtide.operators.joins import interval_join
from logtide.plans import derived as D
from logtide.plans.delivering import effects_schema, latest_view, payment_effects
from logtide.sinks.log import append_log
from logtide.sinks.tables import jdbc_batch_writer
from logtide.sources.files import read_lines
from logtide.sources.log import read_log
from logtide.streaming import jobs
from logtide.streaming.commits import CommitStore, idempotent_batch
from logtide.streaming.progress import ProgressMetrics
from logtide.streaming.retrying import retry_stream

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 1, 1, tzinfo=UTC)


def files_of(df, path, n=3):
    """``df`` as ``n`` files, so that a stream can take several batches."""
    df.repartition(n).write.mode("append").parquet(str(path))
    return str(path)


def stream_of(spark, df, path, n=3, per_batch=1):
    files_of(df, path, n)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(str(path))


def collect_stream(spark, stream, tmp_path, mode="append"):
    """Everything a stream emits, through a Parquet sink or the last state of each update."""
    out = str(tmp_path / "out")
    if mode == "append":
        jobs.drain(stream, out, str(tmp_path / "cp"))
        return spark.read.schema(stream.schema).parquet(out)
    jobs.drain(stream, lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(out),
               str(tmp_path / "cp"), mode)
    return spark.read.parquet(out)


def test_interval_join_stream_equals_batch(spark, sf, tmp_path):
    orders = D.orders(spark, sf).select("order_id", "customer_id", "ts")
    paid = D.payments(spark, sf).select("order_id", "status", F.col("processed_at").alias("paid_at"))
    hour = 3_600_000
    batch = interval_join(orders, paid, ["order_id"], "ts", "paid_at", hour, hour)
    # Whole history in one batch per side: late rows are a matter of the watermark, tested below.
    stream = interval_join(stream_of(spark, orders, tmp_path / "o", 1), stream_of(spark, paid, tmp_path / "p", 1),
                           ["order_id"], "ts", "paid_at", hour, hour, grace="1 minute")
    got = collect_stream(spark, stream, tmp_path)
    assert got.count() > 0
    assert rows(got) == rows(batch)


def test_tumbling_stream_equals_batch_for_closed_windows(spark, tmp_path):
    data = [("succeeded" if i % 3 else "failed", float(i), T0 + dt.timedelta(seconds=17 * i)) for i in range(60)]
    paid = spark.createDataFrame(data, "status string, amount double, processed_at timestamp")
    end = spark.createDataFrame([("failed", 0.0, T0 + dt.timedelta(hours=2))], paid.schema)
    files_of(paid, tmp_path / "in", 1)
    stream = spark.readStream.schema(paid.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    files_of(end, tmp_path / "in", 1)
    got = collect_stream(spark, jobs.tumbling_totals(stream, "processed_at", "1 minute"), tmp_path)
    assert rows(got) == rows(jobs.tumbling_totals(paid, "processed_at"))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "status string, amount double, processed_at timestamp"
    def at(minutes):
        return spark.createDataFrame([("failed", 1.0, T0 + dt.timedelta(minutes=minutes))], schema)
    cp, out = str(tmp_path / "cp"), str(tmp_path / "out")
    dropped = []
    for minutes in (0, 60, 1, 120):
        files_of(at(minutes), tmp_path / "in", 1)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = jobs.drain(jobs.tumbling_totals(stream, "processed_at", "1 minute"), out, cp)
        dropped += [s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]]
    starts = {r.window_start for r in spark.read.parquet(out).collect()}
    assert sum(dropped) == 1
    assert (T0 + dt.timedelta(minutes=1)).replace(tzinfo=None) not in starts and len(starts) == 2


def test_incremental_table_in_update_mode(spark, sf, tmp_path):
    paid = D.payments(spark, sf).select("status", "amount", "processed_at")
    stream = stream_of(spark, paid, tmp_path / "in")
    totals = stream.groupBy("status").agg(F.count("*").alias("n"))
    got = collect_stream(spark, totals, tmp_path, "update")
    assert got.select("batch").distinct().count() == 3
    last = got.groupBy("status").agg(F.max_by("n", "batch"))
    assert rows(last) == rows(paid.groupBy("status").count())


def test_latest_table_upserts(spark, sf, tmp_path):
    rows_of = D.log_payments(spark, sf).select(
        F.col("key").alias("order_id"), F.get_json_object("value", "$.status").alias("status"),
        F.get_json_object("value", "$.amount").cast("double").alias("amount"), "partition", "offset")
    table = jobs.LatestTable(spark, str(tmp_path / "latest"), "order_id", {"status": T.StringType(), "amount": T.DoubleType()})
    table.run(stream_of(spark, rows_of, tmp_path / "in"))
    assert rows(table.current()) == rows(latest_view(spark, sf))
    one = table.pull("order-out-of-stock-2").collect()
    assert [r.status for r in one] == ["refunded"] and one[0].amount is not None


@pytest.fixture
def orders_log(spark, sf, tmp_path):
    """The orders log as a topic folder with one file per partition, first copies only."""
    path = str(tmp_path / "topic")
    append_log(D.log_orders(spark, sf).repartition(4, "partition", F.col("offset") % 4), path)
    return path


def state_of(store):
    return rows(V.payments_state(store.committed("payments"), ["partition", "offset"]))


def apply_all(spark, log_path, root, crash=None):
    store = CommitStore(spark, root, effects_schema())
    stream = read_log(spark, log_path, ["orders"], streaming=True, max_files_per_trigger=1)
    jobs.drain(stream, idempotent_batch(store, payment_effects, crash=crash), root + "-cp")
    return store


@pytest.mark.parametrize("stage", ["before-marker", "after-marker"])
def test_crash_and_restart_apply_everything_once(spark, orders_log, tmp_path, stage):
    plain = apply_all(spark, orders_log, str(tmp_path / "plain"))
    fired = []

    def crash_once(at):
        if at == stage and len(fired) < 2:
            fired.append(at)
            if len(fired) == 2:
                raise RuntimeError("crash")

    with pytest.raises(Exception, match="crash"):
        apply_all(spark, orders_log, str(tmp_path / "run"), crash_once)
    store = apply_all(spark, orders_log, str(tmp_path / "run"))
    assert state_of(store) == state_of(plain)
    total = read_log(spark, orders_log).count()
    for name in ("payments", "outbox"):
        assert store.committed(name).count() == total
    assert store.committed("ledger").agg(F.sum(F.expr("to_offset - from_offset + 1"))).first()[0] == total
    assert store.commits().count() == plain.commits().count() > 1


def test_unmarked_batches_stay_hidden(spark, orders_log, tmp_path):
    def crash(at):
        raise RuntimeError("crash")
    with pytest.raises(Exception, match="crash"):
        apply_all(spark, orders_log, str(tmp_path / "run"), crash)
    store = CommitStore(spark, str(tmp_path / "run"), effects_schema())
    assert store.committed("payments").count() == 0
    assert store.uncommitted("payments").count() > 0


def test_redelivery_in_later_batches_changes_nothing(spark, orders_log, tmp_path):
    store = apply_all(spark, orders_log, str(tmp_path / "run"))
    before = state_of(store)
    again = read_log(spark, orders_log).filter("offset % 10 = 3")
    idempotent_batch(store, payment_effects)(again, 1000)
    assert state_of(store) == before
    assert store.committed("ledger").filter("batch_id = 1000").count() == 0
    # The dead-letter copies of a redelivered record fold the same way.
    letters = retry.dead_letters(outside_ranges(again, store.committed("ledger"), ["topic", "partition"], "offset"))
    assert letters.count() == 0


def test_resume_reads_only_new_files_and_replay_reads_all(spark, sf, tmp_path):
    log = D.log_orders(spark, sf)
    path = str(tmp_path / "topic")
    append_log(log.filter("offset < 100"), path)
    first = jobs.drain(read_log(spark, path, streaming=True), str(tmp_path / "out"), str(tmp_path / "cp"))
    append_log(log.filter("offset >= 100"), path)
    second = jobs.drain(read_log(spark, path, streaming=True), str(tmp_path / "out"), str(tmp_path / "cp"))
    read = [sum(p["numInputRows"] for p in q.recentProgress) for q in (first, second)]
    assert read == [log.filter("offset < 100").count(), log.filter("offset >= 100").count()]
    assert rows(spark.read.parquet(str(tmp_path / "out")), "partition", "offset") == rows(log, "partition", "offset")
    replay = jobs.drain(read_log(spark, path, streaming=True), str(tmp_path / "out2"), str(tmp_path / "cp2"))
    assert sum(p["numInputRows"] for p in replay.recentProgress) == log.count()


def test_slow_hop_lags_only_on_its_own_input(spark, orders_log, tmp_path):
    """Payments drain at once; inventory has its own checkpoint and catches up later."""
    paid_path, inv_path = str(tmp_path / "payments"), str(tmp_path / "inventory")
    orders = read_log(spark, orders_log, streaming=True, max_files_per_trigger=1)
    parsed = orders.select(F.get_json_object("value", "$.orderId").alias("order_id"), F.lit(None).cast("array<string>").alias("items"),
                           F.get_json_object("value", "$.total").cast("double").alias("total"), F.col("timestamp").alias("ts"))
    jobs.drain(stages.to_payments(parsed), paid_path, str(tmp_path / "cp1"))
    done = spark.read.parquet(paid_path).count()
    assert done == read_log(spark, orders_log).count()
    paid = spark.readStream.schema(spark.read.parquet(paid_path).schema).option("maxFilesPerTrigger", 2).parquet(paid_path)
    jobs.drain(stages.to_inventory(paid), inv_path, str(tmp_path / "cp2"))
    assert spark.read.parquet(inv_path).count() == stages.to_inventory(spark.read.parquet(paid_path)).count()


def test_batches_are_bounded(spark, orders_log, tmp_path):
    sizes = []
    jobs.drain(read_log(spark, orders_log, streaming=True, max_files_per_trigger=2), lambda df, i: sizes.append(df.count()),
               str(tmp_path / "cp"))
    assert len(sizes) > 1 and sum(sizes) == read_log(spark, orders_log).count()


def test_follow_takes_new_files_until_stopped(spark, sf, tmp_path):
    log = D.log_orders(spark, sf)
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")
    append_log(log.filter("offset < 50"), path)
    query = jobs.follow(read_log(spark, path, streaming=True), out, str(tmp_path / "cp"), every="1 second", name="follower")
    try:
        query.processAllAvailable()
        append_log(log.filter("offset >= 50"), path)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == log.count()


def test_push_query_stops_at_its_limit(spark, orders_log, tmp_path):
    stream = read_log(spark, orders_log, streaming=True, max_files_per_trigger=1).select("key", "offset")
    out = jobs.push(stream, 40, str(tmp_path / "out"), str(tmp_path / "cp"), ["offset", "key"])
    assert out.count() == 40 and out.distinct().count() == 40


def test_recent_distinct_drops_redeliveries(spark, orders_log, tmp_path):
    log = read_log(spark, orders_log)
    stream = jobs.recent_distinct(stream_of(spark, log.unionByName(log.filter("offset % 7 = 0")), tmp_path / "in", 1),
                                  "timestamp", "10 minutes")
    got = collect_stream(spark, stream, tmp_path)
    assert rows(got, "partition", "offset") == rows(log, "partition", "offset")


def test_relay_publishes_committed_rows_once(spark, orders_log, tmp_path):
    store = apply_all(spark, orders_log, str(tmp_path / "run"))
    outbox = store.committed("outbox").drop("batch_id")
    stream = stream_of(spark, outbox, tmp_path / "outbox")
    write = jobs.relay_writer(str(tmp_path / "topics"))
    jobs.drain(stream, write, str(tmp_path / "cp"))
    write(outbox.limit(0), 99)
    published = spark.read.parquet(str(tmp_path / "topics"))
    assert rows(published, "topic", "key") == rows(outbox, "aggregatetype", "aggregateid")
    # A retried batch overwrites its own folder.
    count = published.count()
    for batch in [r.batch_id for r in published.select("batch_id").distinct().collect()]:
        rows_in = spark.read.parquet(str(tmp_path / "topics")).filter(F.col("batch_id") == batch).select(
            F.lit("i").alias("id"), F.col("topic").alias("aggregatetype"), F.col("key").alias("aggregateid"),
            F.lit("t").alias("type"), F.col("value").alias("payload")).collect()
        write(spark.createDataFrame(rows_in, outbox.schema), batch)
    assert spark.read.parquet(str(tmp_path / "topics")).count() == count


def test_lines_arrive_by_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    cp, out = str(tmp_path / "cp"), str(tmp_path / "out")
    jobs.drain(read_lines(spark, str(tmp_path / "in"), streaming=True), out, cp)
    (tmp_path / "in" / "b.txt").write_text("three\n")
    jobs.drain(read_lines(spark, str(tmp_path / "in"), streaming=True), out, cp)
    assert rows(spark.read.parquet(out)) == sorted([("one",), ("two",), ("three",)], key=repr)


def test_retry_stream_waits_in_state(spark, tmp_path):
    def flaky(order_id, attempt):
        if "permanent-fail" in order_id:
            return f"rejected {attempt}"
        if "transient-fail-3" in order_id and attempt < 3:
            return f"timeout {attempt}"
        return None

    schema = "order_id string, ts timestamp"
    ids = ["order-normal-1", "order-transient-fail-3", "order-permanent-fail-1"]
    cp, out = str(tmp_path / "cp"), str(tmp_path / "out")
    batches = [[(i, T0) for i in ids], [("order-a", T0 + dt.timedelta(minutes=5))], [("order-b", T0 + dt.timedelta(minutes=10))],
               [("order-c", T0 + dt.timedelta(minutes=15))]]
    for data in batches:
        files_of(spark.createDataFrame(data, schema), tmp_path / "in", 1)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.drain(retry_stream(stream, flaky), out, cp)
    got = spark.read.parquet(out).filter(F.col("order_id").isin(ids))
    assert rows(got, "order_id", "attempt", "outcome", (F.unix_millis("at") - int(T0.timestamp() * 1000)).alias("wait")) == [
        ("order-normal-1", 1, "success", 0),
        ("order-permanent-fail-1", 1, "retry", 0), ("order-permanent-fail-1", 2, "retry", 200),
        ("order-permanent-fail-1", 3, "exhausted", 600),
        ("order-transient-fail-3", 1, "retry", 0), ("order-transient-fail-3", 2, "retry", 200),
        ("order-transient-fail-3", 3, "success", 600)]


def test_terminal_states_from_a_stream(spark, tmp_path):
    events = spark.createDataFrame([
        ("a", "orders", None), ("a", "payments", "succeeded"), ("a", "inventory", None), ("a", "shipping", None),
        ("b", "orders", None), ("b", "payments", "failed"), ("c", "orders", None), ("c", "payments", "succeeded"),
        ("c", "payments", "refunded"), ("d", "orders", None)], "order_id string, topic string, status string")
    got = collect_stream(spark, stages.terminal_states(stream_of(spark, events, tmp_path / "in")), tmp_path, "update")
    last = got.groupBy("order_id").agg(F.max_by("state", "batch"))
    assert rows(last) == [("a", "completed"), ("b", "declined"), ("c", "compensated"), ("d", "in-flight")]


def test_progress_becomes_metric_samples(spark, orders_log, tmp_path):
    listener = ProgressMetrics()
    spark.streams.addListener(listener)
    try:
        jobs.drain(read_log(spark, orders_log, streaming=True).groupBy("partition").count(), lambda df, i: df.count(),
                   str(tmp_path / "cp"), "update")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    samples = listener.drain(spark)
    total = samples.filter("name = 'stream_input_rows'").agg(F.sum("value")).first()[0]
    assert total == read_log(spark, orders_log).count()
    assert samples.filter("name = 'stream_state_rows'").agg(F.max("value")).first()[0] == 3.0
    assert listener.drain(spark).count() == 0


def test_no_progress_sample_is_dropped(spark):
    listener, events = ProgressMetrics(), 17_000
    for i in range(events):
        state = SimpleNamespace(numRowsTotal=1, numRowsDroppedByWatermark=i % 2)
        listener.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(
            name="q", id=1, runId=2, batchId=i, numInputRows=i, inputRowsPerSecond=float("nan"), processedRowsPerSecond=None,
            timestamp="2026-01-01T00:00:00.000Z", stateOperators=[state])))
    samples = listener.drain(spark)
    got = {r.name: tuple(r)[1:] for r in samples.groupBy("name").agg(F.count("*"), F.sum("value")).collect()}
    assert sum(n for n, _ in got.values()) == 6 * events > 100_000
    assert got["stream_input_rows"] == got["stream_batch_id"] == (events, events * (events - 1) / 2)
    assert got["stream_late_rows_dropped"] == (events, events / 2)
    first = samples.filter("name = 'stream_batch_id' AND value = 0").first()
    assert first.labels == {"query": "q", "run": "2"} and first.ts is not None
    assert listener.drain(spark).count() == 0


def test_state_is_evicted_behind_the_join_window(spark, tmp_path):
    """State rows at the end follow the width of the join window, not the length of the stream."""
    schema = "k string, ts timestamp"
    kept = {}
    for name, before in (("narrow", 60_000), ("wide", 3_600_000)):
        for i in range(3):
            data = [(f"k{i}-{j}", T0 + dt.timedelta(minutes=20 * i + j)) for j in range(10)]
            df = spark.createDataFrame(data, schema)
            files_of(df, tmp_path / name / "l", 1)
            files_of(df.withColumnRenamed("ts", "ts2"), tmp_path / name / "r", 1)
            l = spark.readStream.schema(schema).parquet(str(tmp_path / name / "l"))
            r = spark.readStream.schema("k string, ts2 timestamp").parquet(str(tmp_path / name / "r"))
            q = jobs.drain(interval_join(l, r, ["k"], "ts", "ts2", before, before, grace="1 minute"),
                           str(tmp_path / name / "out"), str(tmp_path / name / "cp"))
            kept[name] = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
        assert spark.read.parquet(str(tmp_path / name / "out")).count() >= 30
    assert kept["narrow"] < kept["wide"]


def test_handlers(spark):
    log = spark.createDataFrame([("a", "1"), ("b", "x")], "key string, value string")
    doubled = jobs.transform_log(log, lambda v: (v.try_cast("int") * 2).cast("string"))
    assert rows(doubled) == [("a", "2")]

    def call(batches):
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "ok": pdf["value"].str.isdigit()})

    assert rows(jobs.call_downstream(log, call, "key string, ok boolean")) == [("a", True), ("b", False)]


def test_jdbc_writer_appends_plainly():
    class Writer:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            def record(*a, **k):
                self.calls.append((name, a, k))
                return self
            return record

    class Batch:
        write = Writer()

    jdbc_batch_writer("jdbc:x", "payments", user="u")(Batch, 7)
    assert Batch.write.calls == [
        ("format", ("jdbc",), {}), ("mode", ("append",), {}),
        ("options", (), {"url": "jdbc:x", "dbtable": "payments", "batchsize": "10000", "user": "u"}), ("save", (), {})]
