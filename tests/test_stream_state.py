"""State that must survive: growing files, polled tables, limits, ledgers of ranges, open transactions, pull queries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from conftest import rows
from logtide.operators import delivery as V
from logtide.operators.intervals import merge_ranges, outside_ranges, to_ranges
from logtide.plans import derived as D
from logtide.sources.log import read_log
from logtide.sources.tail import GrowingLinesReader, tail_lines
from logtide.streaming import jobs
from logtide.streaming.commits import LEDGER, CommitStore, IntervalLedger
from logtide.streaming.polling import Polling, clock
from logtide.streaming.transactions import committed_stream

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 1, 1, tzinfo=UTC)


# -- growing files


def tail(spark, path, tmp_path, **options):
    jobs.drain(tail_lines(spark, str(path), **options), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.schema("path string, offset long, line string").parquet(str(tmp_path / "out")).collect()
    return sorted((r.path.rsplit("/", 1)[1], r.offset, r.line) for r in got)


def append(path, data: bytes):
    with open(path, "ab") as f:
        f.write(data)


def test_appended_lines_arrive_once_and_half_lines_wait(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    append(folder / "a.log", b"one\ntwo\nhal")
    append(folder / "_hidden", b"no\n")
    assert tail(spark, folder, tmp_path) == [("a.log", 0, "one"), ("a.log", 4, "two")]
    assert len(tail(spark, folder, tmp_path)) == 2  # nothing new
    append(folder / "a.log", b"f\r\n\nlast \xff\n")
    append(folder / "b.log", "é\n".encode())
    want = [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "half"), ("a.log", 14, ""), ("a.log", 15, "last �"), ("b.log", 0, "é")]
    assert tail(spark, folder, tmp_path) == want
    append(folder / "b.log", b"no end")
    assert tail(spark, folder, tmp_path) == want
    (folder / "b.log").write_bytes(b"x\n")  # shorter than before: from its beginning
    assert tail(spark, folder, tmp_path) == sorted([*want, ("b.log", 0, "x")])


def test_tail_of_one_file_in_bounded_batches_and_splits(spark, tmp_path):
    rng = random.Random(1)
    lines = ["x" * rng.choice([0, 1, 30, 400]) + str(i) for i in range(300)]
    append(tmp_path / "a.log", ("\n".join(lines) + "\n").encode())
    options = {"maxBytesPerTrigger": "2000", "positions": str(tmp_path / "pos" / "at.json"), "splitBytes": "700"}
    seen = []
    query = tail_lines(spark, str(tmp_path / "a.log"), **options).writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(
        lambda b, i: seen.append((i, [tuple(r) for r in b.select("offset", "line").collect()]))).start()
    try:
        query.processAllAvailable()
        append(tmp_path / "a.log", b"more\n")
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted(r for _, batch in seen for r in batch)
    assert [x for _, x in got] == [*lines, "more"]
    assert len(seen) > 10 and all(sum(len(x) + 1 for _, x in batch) <= 2000 for _, batch in seen)
    # A restarted reader stands where the last planned batch ended.
    again = GrowingLinesReader({"path": str(tmp_path / "a.log"), **options})
    assert again.latestOffset() == {"files": {str(tmp_path / "a.log"): (tmp_path / "a.log").stat().st_size}}
    with pytest.raises(ValueError, match="positions"):
        GrowingLinesReader({"path": str(tmp_path), "maxBytesPerTrigger": "10"})


def test_every_split_of_a_file_gives_each_line_once(tmp_path):
    data = b"a\n\nbbbb\r\ncc\n" + b"d" * 3000 + b"\ne\n"
    (tmp_path / "f").write_bytes(data)
    for size in (1, 2, 3, 7, 5000):
        reader = GrowingLinesReader({"path": str(tmp_path / "f"), "splitBytes": str(size)})
        start, end = reader.initialOffset(), reader.latestOffset()
        got = [r for p in reader.partitions(start, end) for b in reader.read(p) for r in b.to_pylist()]
        assert [r["line"] for r in got] == ["a", "", "bbbb", "cc", "d" * 3000, "e"]
        assert [r["offset"] for r in got] == [0, 2, 3, 9, 12, 3013]
    one = GrowingLinesReader({"path": str(tmp_path / "f"), "maxBytesPerTrigger": "5", "positions": str(tmp_path / "p")})
    ends = []
    while not ends or ends[-1] < len(data):
        at = {"files": {str(tmp_path / "f"): ends[-1]}} if ends else {"files": {}}
        end = one.latestOffset()
        one.partitions(at, end)
        ends.append(end["files"][str(tmp_path / "f")])
    assert ends == [3, 9, 12, 3013, 3015]  # a line longer than the bound still comes whole


def test_no_files_yet(spark, tmp_path):
    assert tail_lines(spark, str(tmp_path / "none")).isStreaming
    assert GrowingLinesReader({"path": str(tmp_path / "none")}).latestOffset() == {"files": {}}


# -- polled tables

ORDERS = "id long, changed timestamp, v string"


class Growing:
    """A table that grows between polls."""

    def __init__(self, spark):
        self.spark, self.rows = spark, []

    def read(self):
        return self.spark.createDataFrame(self.rows, ORDERS)


def at(minute):
    return None if minute is None else T0 + dt.timedelta(minutes=minute)


def test_polls_across_restarts_give_every_row_once(spark, tmp_path):
    table = Growing(spark)
    steps = [[], [(1, at(1), "a"), (2, at(2), "b"), (9, at(None), "never")], [(3, at(2), "late, equal"), (4, at(3), None)], [], [(5, at(3), "equal again")],
             [(6, at(3), "and again"), (7, at(4), "x")]]
    want = {1: 1, 2: 1, 3: 2, 4: 2, 5: 4, 6: 5, 7: 5}
    for n, more in enumerate(steps):
        table.rows += more
        Polling(spark, str(tmp_path / "polls"), table.read, "changed", "id").poll(None, n)  # a new process each time
    got = Polling(spark, str(tmp_path / "polls"), table.read, "changed", "id").rows().collect()
    assert sorted((r.id, r.batch_id) for r in got) == sorted(want.items())


def test_a_crashed_poll_reads_the_same_range_again(spark, tmp_path):
    table = Growing(spark)
    table.rows += [(1, at(1), "a"), (2, at(2), "b")]

    def crash(stage):
        raise RuntimeError("crash")
    with pytest.raises(RuntimeError):
        Polling(spark, str(tmp_path / "polls"), table.read, "changed", "id", crash).poll(None, 0)
    polls = Polling(spark, str(tmp_path / "polls"), table.read, "changed", "id")
    assert polls.rows().count() == 0
    table.rows += [(3, at(9), "inserted meanwhile"), (4, at(2), "equal")]
    polls.poll(None, 0)
    assert sorted(r.id for r in polls.rows().collect()) == [1, 2, 4]
    polls.poll(None, 0)  # a committed poll is left alone
    polls.poll(None, 1)
    assert sorted((r.id, r.batch_id) for r in polls.rows().collect()) == [(1, 0), (2, 0), (3, 1), (4, 0)]


def test_polls_paced_by_a_clock(spark, tmp_path):
    table = Growing(spark)
    table.rows += [(i, at(i), "x") for i in range(20)]
    polls = Polling(spark, str(tmp_path / "polls"), table.read, "changed", "id")
    query = jobs.follow(clock(spark), polls.poll, str(tmp_path / "cp"), "1 second")
    try:
        while polls.store.commits().count() < 2:
            assert not query.awaitTermination(1)
        table.rows += [(100, at(100), "y")]
        while polls.rows().count() < 21:
            assert not query.awaitTermination(1)
    finally:
        query.stop()
    assert polls.rows().count() == 21


# -- a limit


@pytest.fixture
def numbers(spark, tmp_path):
    for i in range(6):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    return lambda: spark.readStream.schema("id long, part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).select("id")


@pytest.mark.parametrize("stage", ["before-marker", "after-marker"])
@pytest.mark.parametrize("when", [1, 3])
def test_a_limit_survives_a_crash(spark, numbers, tmp_path, stage, when):
    fired = []

    def crash(where):
        fired.append(where)
        if where == stage and fired.count(stage) == when:
            raise RuntimeError("crash")
    root, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    with pytest.raises(Exception, match="crash"):
        jobs.push(numbers(), 25, root, cp, ["id"], "0 seconds", crash)
    out = jobs.push(numbers(), 25, root, cp, ["id"], "0 seconds")
    assert out.count() == 25 and out.distinct().count() == 25
    assert jobs.push(numbers(), 25, root, cp, ["id"], "0 seconds").count() == 25  # done: starts nothing


# -- ledger of ranges


def test_ranges_are_the_offsets_they_stand_for(spark):
    rng = random.Random(7)
    offsets = sorted(rng.sample(range(200), 120))
    df = spark.createDataFrame([("t", p, o, T0) for p in (0, 1) for o in offsets if p == 0 or o < 90], "topic string, partition int, offset long, at timestamp")
    ranges = to_ranges(df, ["topic", "partition"], "offset", "at", 50)
    back = ranges.select("topic", "partition", F.explode(F.sequence("from_offset", "to_offset")).alias("offset"))
    assert rows(back) == rows(df, "topic", "partition", "offset")
    assert all(r.from_offset // 50 == r.to_offset // 50 == r.block for r in ranges.collect())
    halves = [to_ranges(df.where(F.col("offset") % 2 == i), ["topic", "partition"], "offset", "at", 50).drop("processed_at") for i in (0, 1)]
    merged = merge_ranges(halves[0].unionByName(halves[1]).unionByName(halves[1]), ["topic", "partition"])
    assert rows(merged, "partition", "from_offset", "to_offset") == rows(ranges, "partition", "from_offset", "to_offset")
    every = spark.range(-5, 210).select(F.lit("t").alias("topic"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("partition"), F.col("id").alias("offset"))
    outside = outside_ranges(every, halves[0].unionByName(halves[1]).unionByName(merged), ["topic", "partition"], "offset", 50)
    taken = {(r.partition, r.offset) for r in df.collect()}
    assert {(r.partition, r.offset) for r in outside.collect()} == {(p, o) for p in (0, 1, 2) for o in range(-5, 210)} - taken


def test_a_batch_reads_as_much_ledger_late_as_early(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path / "s"), {"ledger": LEDGER})
    ledger = IntervalLedger(store, block_rows=1000, fold_every=4)
    files = {}
    for batch_id in range(19):
        new = spark.range(batch_id * 10 - 3, batch_id * 10 + 10).where("id >= 0").select(
            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(T0).alias("timestamp"))
        fresh = ledger.fresh(new, batch_id)
        files[batch_id] = len(ledger.seen(batch_id).inputFiles())
        assert sorted(r.offset for r in fresh.collect()) == list(range(batch_id * 10, batch_id * 10 + 10))
        ledger.add(fresh, batch_id, "timestamp")
        if batch_id == 6:
            ledger.add(fresh, batch_id, "timestamp")  # a retry changes nothing
        store.mark(batch_id)
    assert files[6] == files[18] and max(files.values()) <= files[7]
    assert [(r.from_offset, r.to_offset) for r in store.of_batches("ledger-base", [16], ledger.base).collect()] == [(0, 159)]
    assert ledger.seen(100).count() == 19  # ids with a gap: all committed ranges


def test_markers_are_found_by_path(spark, tmp_path):
    store = CommitStore(spark, str(tmp_path / "s"), {"t": T.StructType().add("a", "long")})
    assert not store.is_committed(0)
    for i in range(3):
        store.commit(i, {"t": spark.range(i).select(F.col("id").alias("a"))})
    assert store.is_committed(2) and not store.is_committed(3)
    assert len(store.of_batches("commits", [1], T.StructType().add("committed_at", "timestamp")).inputFiles()) == 1
    assert store.of_batches("t", [2, 9]).count() == 2


# -- transactions


def test_committed_stream_equals_read_committed(spark, sf, tmp_path):
    log = D.transactional(D.log_orders(spark, sf).limit(400)).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset")))
    ends = log.agg(F.max("offset")).first()[0]
    for i in range(3):  # three batches in log order
        part = log.where(F.floor(F.col("offset") * 3 / (ends + 1)) == i)
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).select(*log.columns)
    out = committed_stream(stream, 3_600_000)
    jobs.drain(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    want = V.read_committed(log)
    assert want.count() > 100
    columns = ["topic", "partition", "offset", "key", "producer_id", "timestamp"]
    assert rows(got.where("verdict = 'committed'"), *columns) == rows(want, *columns)


def test_open_transactions_are_shown_and_still_decided(spark, tmp_path):
    schema = "topic string, partition int, offset long, producer_id string, control string, timestamp timestamp, key string, n double"

    def put(i, *records):
        spark.createDataFrame([("t", 0, o, p, c, at(m), k, 1.5) for o, p, c, m, k in records], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b={i}"))
    put(0, (0, "p", None, 0, "a"), (1, "q", None, 0, "b"), (2, None, None, 0, "c"), (3, "r", None, 0, "d"), (4, "r", "ABORT", 0, None), (5, "r", None, 0, "e"),
        (6, "r", "COMMIT", 0, None))
    put(1, (7, None, None, 60, "late clock"))
    put(2, (8, None, None, 61, "x"))
    put(3, (9, "p", "COMMIT", 62, None), (10, "q", "ABORT", 62, None), (11, "q", None, 62, "f"))
    put(4, (12, "q", "COMMIT", 63, None))
    stream = spark.readStream.schema(schema + ", b int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).drop("b")
    out = committed_stream(stream, 10 * 60_000, "1 minute")
    jobs.drain(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.verdict, r.offset, r.key, r.producer_id, r.n) for r in spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect())
    assert [g[:3] for g in got if g[0] == "open"] == [("open", 0, "a"), ("open", 1, "b")]
    assert [(g[1], g[2], g[3]) for g in got if g[0] == "committed"] == [
        (0, "a", "p"), (2, "c", None), (5, "e", "r"), (7, "late clock", None), (8, "x", None), (11, "f", "q")]
    assert all(g[4] == 1.5 for g in got)


# -- pull queries


def test_a_pull_reads_state_and_not_batches(spark, tmp_path):
    schema = "k string, partition int, offset long, status string, amount double"
    table = jobs.LatestTable(spark, str(tmp_path / "cp"), "k", {"status": T.StringType(), "amount": T.DoubleType()})
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    want = {}
    for i in range(5):
        spark.createDataFrame([(k, 0, i * 10 + j, f"s{i}" if (i + j) % 2 else None, float(i) if k != "c" else None) for j, k in enumerate("abc")], schema).coalesce(
            1).write.mode("append").parquet(str(tmp_path / "in"))
        table.run(stream)
        for j, k in enumerate("abc"):
            old = want.get(k, (None, None))
            want[k] = (f"s{i}" if (i + j) % 2 else old[0], float(i) if k != "c" else None)
        assert {r.k: (r.status, r.amount) for r in table.current().collect()} == want
    assert table.current().count() == 3  # one row per key after five batches
    assert [tuple(r) for r in table.pull("b").collect()] == [("b", *want["b"])] and table.pull("none").count() == 0
    assert {r.k: r.amount for r in table.current(batchId="1").collect()} == {"a": 1.0, "b": 1.0, "c": None}
    meta = table.state_metadata().first()
    assert meta.maxBatchId == 4
