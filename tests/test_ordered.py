"""Order-dependent operators and key hashing against brute force on small random data."""

import random
from collections import defaultdict

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from logtide.functions.hashing import murmur2, murmur2_batch, murmur2_native, partition_for
from logtide.operators import ordered as O
from logtide.operators.ordered import chunked_positions, order_bounds
from logtide.operators.partitions import hot_keys
from logtide.operators.sketches import hot_keys_sketched, key_sketches, smallest_share


def sample(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        # Series "a" holds most rows; positions are sparse, so chunks are empty now and then.
        k = "a" if rnd.random() < 0.7 else rnd.choice("bcd")
        out.append((k, rnd.randrange(10_000), rnd.choice([None, 1.0, 2.0, 5.0, -3.0])))
    unique = {(k, p): (k, p, v) for k, p, v in out}
    return list(unique.values())


def frame(spark, data):
    return spark.createDataFrame(data, "k string, p bigint, v double").repartition(4)


def series(data):
    by = defaultdict(list)
    for k, p, v in sorted(data, key=lambda r: (r[0], r[1])):
        by[k].append((p, v))
    return by


def test_dense_positions(spark):
    data = sample(1, 2000)
    got = rows(O.dense_positions(frame(spark, data), ["k"], ["p"]), "k", "p", "position")
    want = sorted(((k, p, i) for k, s in series(data).items() for i, (p, _) in enumerate(s)), key=repr)
    assert got == want


def test_chunked_neighbours(spark):
    data = sample(2)
    chunk = O.offset_chunk("p", 37)
    lag = rows(O.chunked_lag(frame(spark, data), ["k"], ["p"], ["v", "p"], chunk), "k", "p", "prev_v", "prev_p")
    lead = rows(O.chunked_lead(frame(spark, data), ["k"], ["p"], ["p"], chunk), "k", "p", "next_p")
    want_lag, want_lead = [], []
    for k, s in series(data).items():
        for i, (p, _) in enumerate(s):
            want_lag.append((k, p, s[i - 1][1] if i else None, s[i - 1][0] if i else None))
            want_lead.append((k, p, s[i + 1][0] if i + 1 < len(s) else None))
    assert lag == sorted(want_lag, key=repr)
    assert lead == sorted(want_lead, key=repr)


def test_chunked_running_max_and_next_known(spark):
    data = sample(3)
    chunk = O.offset_chunk("p", 53)
    top = rows(O.chunked_running_max(frame(spark, data), ["k"], ["p"], "v", chunk, "m"), "k", "p", "m")
    nxt = rows(O.chunked_next_known(frame(spark, data), ["k"], ["p"], "v", chunk, "n"), "k", "p", "n")
    want_top, want_next = [], []
    for k, s in series(data).items():
        for i, (p, _) in enumerate(s):
            seen = [v for _, v in s[: i + 1] if v is not None]
            ahead = [v for _, v in s[i:] if v is not None]
            want_top.append((k, p, max(seen) if seen else None))
            want_next.append((k, p, ahead[0] if ahead else None))
    assert top == sorted(want_top, key=repr)
    assert nxt == sorted(want_next, key=repr)


def test_trailing_sum_crosses_blocks(spark):
    data = [(k, p, v or 0.0) for k, p, v in sample(4)]
    df = frame(spark, data).select("k", F.timestamp_seconds("p").alias("ts"), "p", "v")
    got = rows(O.trailing_sum(df, ["k"], "ts", "v", 300, "s", block_seconds=300), "k", "p", "s")
    want = [(k, p, sum(v for q, v in s if p - 300 < q <= p)) for k, s in series(data).items() for p, _ in s]
    assert got == sorted(want, key=repr)


def reference_murmur2(data: bytes) -> int:
    """Word-at-a-time form for checking the vectorised ones."""
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    whole = len(data) - len(data) % 4
    for i in range(0, whole, 4):
        k = int.from_bytes(data[i:i + 4], "little") * m & mask
        h = (h * m & mask) ^ ((k ^ k >> 24) * m & mask)
    if whole < len(data):
        h = (h ^ int.from_bytes(data[whole:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=20))
def test_murmur2_batch(keys):
    keys = [k if k is None else k.encode("utf-8", "ignore").decode() for k in keys]
    got = murmur2_batch(pd.Series(keys, dtype=object))
    for k, h in zip(keys, got):
        assert (h is pd.NA) if k is None else h == reference_murmur2(k.encode())


def test_murmur2_forms_agree(spark):
    keys = ["", "a", "ab", "abc", "abcd", "order-1", "größe-ß", "x" * 101, "日本語キー", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for r in df.select("k", murmur2(F.col("k")).alias("a"), murmur2_native(F.col("k")).alias("b")).collect():
        want = None if r.k is None else reference_murmur2(r.k.encode())
        assert (r.a, r.b) == (want, want)


def test_published_placements(spark):
    def place(keys, n):
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        return [r[0] for r in df.select(partition_for(F.col("k"), n)).collect()]

    assert place([f"order-{i}" for i in range(1, 7)], 3) == [1, 0, 0, 2, 2, 0]
    assert place(["customer-VIP"], 6) == [5]
    assert place(["customer-VIP"], 24) == [23]


def test_chunked_positions_are_row_numbers(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), None if rng.random() < 0.05 else rng.choice([1, 1, 1, rng.randint(0, 50)]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, t int, no int").repartition(7)
    want = {}
    for g in ("a", "b", None):
        mine = sorted((x for x in data if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        want |= {x[2]: i for i, x in enumerate(mine)}
    for chunks in (1, 3, 64):
        got = {r.no: r.position for r in chunked_positions(df, ["g"], ["t", "no"], chunks=chunks).collect()}
        assert got == want
    assert {r.no: r.position for r in chunked_positions(df.drop("g"), [], ["no"]).collect()} == {i: i for i in range(3000)}
    assert chunked_positions(df.limit(0), ["g"], ["t", "no"]).count() == 0
    # Ties in the first column are cut by the next, so one value of it is no single chunk.
    assert len(order_bounds(df.where("t = 1"), ["t", "no"], 8)) == 7


def test_sketches_find_every_hot_key(spark):
    rng = random.Random(6)
    keys = ["hot"] * 900 + ["warm"] * 300 + [None] * 50 + [f"k{rng.randint(0, 5000)}" for _ in range(5000)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "key string, day int").repartition(6)
    sketches = key_sketches(df, "key", F.col("day"), 1000)
    assert sketches.count() == 3 and sketches.agg(F.sum("records")).first()[0] == len(keys)
    for window, share in ((None, 0.02), (F.col("day"), 0.02)):
        exact = hot_keys(df, "key", share, window).where("key IS NOT NULL")
        found = hot_keys_sketched(df, "key", sketches, share, 1000, window)
        columns = exact.columns
        assert sorted(map(tuple, found.select(*columns).collect())) == sorted(map(tuple, exact.collect())) != []
    with pytest.raises(ValueError, match="sketch"):
        hot_keys_sketched(df, "key", sketches, smallest_share(1000) / 2, 1000)
