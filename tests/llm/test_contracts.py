"""Mixing of null and repeated ids, the Pareto draw, near duplicates under one id, texts of many languages."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import language, mixing, stages
from tests.llm import plain
from tests.llm.test_operators import check_mix

ROWS = "doc_id long, text string, source string"


def words(n):
    return "w " * n


def ids(kind, i):
    return {"own": i, "null": None, "one": 7, "ten": i % 10}[kind]


@pytest.mark.parametrize("kind, copies", [("own", 1), ("null", 6), ("one", 1), ("ten", 6)])
def test_mix_meets_targets_whatever_the_ids(spark, kind, copies):
    """Distinct texts, and texts that ``copies`` rows share entirely."""
    rng = random.Random(2)
    rows = [(ids(kind, i // copies), words(1 + (i // copies) % 40), "a" if i % 5 else "b") for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ROWS)
    found = mixing.mix(df).collect()
    check_mix(rows, found)
    again = mixing.mix(df.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    wide = Counter((r.doc_id, r.text, r.source, r.mark) for r in mixing.mixed_rows(df.withColumn("mark", F.lit(1))).collect())
    taken = Counter()
    for r in found:
        taken[r.doc_id, r.size, r.source] += r.copies
    assert Counter({(d, len(plain.words(t)), s): 0 for d, t, s, _ in wide} | {k: v for k, v in taken.items() if v}) == Counter(
        {k: v for k, v in taken.items() if v})
    assert sum(n for n in wide.values()) == sum(taken.values())


def test_mix_is_a_pareto_draw(spark):
    """Order by random odds over inclusion odds, probabilities as the square root of the size, words taken up to the need."""
    docs = spark.createDataFrame([(i, words(i * 37 % 300), "abc"[i % 7 % 3]) for i in range(2000)], ROWS)
    drawn, repeated, factors, _, cuts = mixing._plan(docs, "doc_id", "text", "source", mixing.WEIGHTS, 3.0, mixing.by_length(), 17)
    c = {r.source: r._c for r in factors.collect()}
    got = mixing._copies(drawn, cuts).collect()
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    seen = set()
    for source, rows in by.items():
        p = np.array([min(1.0, c[source] * r.size ** 0.5) for r in rows])
        need = rows[0]._need
        sizes = np.array([r.size for r in rows])
        assert (p * sizes).sum() == pytest.approx(min(need, sizes.sum()), rel=1e-6)
        taken, before = set(), 0
        for r in sorted(rows, key=lambda r: (r._y, r.k1, r.k2, r.rank)):
            if before + r.size / 2 <= need and need > 0:
                taken.add(r.doc_id)
            before += r.size
        assert {r.doc_id for r in rows if r.copies > r._whole and r.size} == {r.doc_id for r in rows if r.doc_id in taken and r.size}
        # Unequal probabilities: what is drawn is longer than the average.
        if 50 < len(taken) < len(rows) - 50:
            seen.add(source)
            assert np.mean([r.size for r in rows if r.doc_id in taken]) > sizes.mean()
    assert seen and not repeated


def test_mix_takes_a_preference_of_its_own(spark):
    rows = [(i, words(10), "a" if i % 4 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, ROWS)
    check_mix(rows, mixing.mix(df, preference=F.lit(1.0)).collect())


def test_near_duplicates_keeps_texts_that_only_share_an_id(spark):
    """Of clashing texts under one id none is lost, and copies go whatever their ids are."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(20)]
    near = [t.split() for t in texts]
    near = [" ".join([*w[:50], "other", *w[51:]]) for w in near]
    rows = [(7, t, "s") for t in texts] + [(None, t, "s") for t in texts[:3]] + [(3, near[0], "s"), (3, texts[0], "s"), (9, near[1], "s"), (7, near[2], "s"), (7, texts[4], "s")]
    rows += [(1, None, "s"), (1, None, "s"), (2, "", "s"), (2, " ", "s"), (None, None, "s")]
    docs = spark.createDataFrame(rows, ROWS)
    got = [(r.doc_id, r.text) for r in stages.near_duplicates(spark, docs, "").collect()]
    kept = [t for _, t in got if t and t.strip()]
    assert len(kept) == 20 and Counter(d for d, t in got if t and t.strip()) == {7: 19, 3: 1}
    groups = [{texts[i], near[i]} for i in range(20)]
    assert all(sum(t in g for t in kept) == 1 for g in groups)
    assert Counter(g for g in got if not (g[1] or "").strip()) == Counter([(1, None)] * 2 + [(2, ""), (2, " "), (None, None)])
    again = [(r.doc_id, r.text) for r in stages.near_duplicates(spark, docs.repartition(7), "").collect()]
    assert Counter(again) == Counter(got)


def test_twelve_languages_in_one_text(spark):
    """No limit on the set of languages: the penalty alone ends it."""
    rng = random.Random(1)
    alphabets = ["abc", "def", "ghi", "jkl", "mno", "pqr", "stu", "vwx", "yzä", "öüß", "éèê", "ñóí"]
    word = lambda a: "".join(rng.choice(a) for _ in range(6))
    train = [(i, " ".join(word(a) for _ in range(300)), f"l{i:02}") for i, a in enumerate(alphabets)]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.fit(df, F.lit(True))
    mixed = spark.createDataFrame([(1, " ".join(word(a) for _ in range(40) for a in alphabets))], "doc_id long, text string")
    got = language.predict(mixed, model).first()
    assert set(got.mixture) == {x for _, _, x in train} and sum(got.mixture.values()) == pytest.approx(1)


def test_mixture_is_the_plain_em(spark):
    """Shares and set against the textbook loop on one likelihood table."""
    rng = np.random.default_rng(3)
    true = np.repeat([0, 1, 2], [60, 30, 10])
    loglike = -3.0 * rng.random((100, 5)) - 4.0
    loglike[np.arange(100), true] += 4.0

    def em(columns, rounds):
        like, share = np.exp(loglike[:, columns]), [1 / len(columns)] * len(columns)
        for _ in range(rounds):
            sums = [0.0] * len(columns)
            for row in like:
                total = sum(s * x for s, x in zip(share, row, strict=True))
                for j in range(len(columns)):
                    sums[j] += share[j] * row[j] / total
            share = [s / len(like) for s in sums]
        return share, sum(np.log(sum(s * x for s, x in zip(share, row, strict=True))) for row in like)
    start, _ = em(list(range(5)), 4)
    chosen = [int(np.argmax(loglike.sum(axis=0)))]
    best, part = loglike[:, chosen[0]].sum(), [1.0]
    for k in sorted(range(5), key=lambda k: -start[k]):
        if k in chosen or start[k] < 1e-3:
            continue
        share, value = em([*chosen, k], 12)
        if value - best <= 0.5 * np.log(100) + 1:
            break
        chosen, best, part = [*chosen, k], value, share
    first, score, spread = language.infer(loglike)
    assert first == 0 and sorted(np.nonzero(spread)[0]) == sorted(chosen) == [0, 1, 2]
    assert [spread[k] for k in chosen] == pytest.approx(part, rel=1e-6)


def test_language_counts_hold_one_slice_of_texts():
    """Counting turns a slice of a batch into Python strings at a time: the peak above the batch is far below its texts."""
    import tracemalloc

    import pyarrow as pa
    texts = [f"palabra{i} " * 400 for i in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["es", "en"] * 2000)], names=["text", "lang"])
    size, whole = batch.column(0).nbytes, language._count(64, 64)
    language.word_grams("a")  # builds the table of letters, which stays
    del texts
    tracemalloc.start()
    try:
        got = list(whole(iter([batch.slice(0, 0), batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < size / 4
    assert sum(sum(r["counts"]) for b in got for r in b.to_pylist()) == 4000 * 400 * 7
