"""Each operator against a plain version on the small tables, and on tables of odd cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import embed_dedup, language, mixing, packing, pii, queries, secret_scan, sharding, shingle_join, topk, toxicity
from logtide.llm.common import connected_components, documents, held_out, label_nodes
from logtide.sources.tables import table
from tests.llm import plain

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, k1 string, copies int"


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text) for r in documents(spark, sf).collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(4)
    base = [rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(400)]
    near = base[:]
    near[200] = "zzz"
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "one", None, "a"), (5, "ONE", "fr", None),
            (None, "one two three", "en", "b"), (None, None, None, None), (6, " ".join(base), "en", "b"), (7, "\n".join(base).upper(), "en", "b"),
            (8, " ".join(near), "en", "b"), (9, " ".join(near), "en", "b"), (9, " ".join(near), "en", "b"), (10, "one two three four", "en", "c"),
            (11, "word " * 60_000, "en", "c"), (12, "mail a.b@c.de or +1 (234) 567-8901, 10.0.0.1, 4111 1111 1111 1111", "en", "c"),
            (13, "日本語 ñandú é", "es", "c"), (14, "x" * 30_000, "en", "c"), (15, "1" * 20_000 + ".1.1.1", None, "c")]
    return spark.createDataFrame([(d, t, x, s, None, 7, "k", 3) for d, t, x, s in rows], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_components_of_chain_star_and_loop(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(7, 7), (500, 500)]
    for local in (1 << 20, 0):  # in one task, and in rounds
        found = dict(collected(connected_components(spark.createDataFrame(rows, "a long, b long"), local_edges=local), "node", "component"))
        assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(200)}
        assert connected_components(spark.createDataFrame([], "a long, b long"), local_edges=local).count() == 0


def test_labels_of_random_graphs():
    rng = np.random.default_rng(8)
    for n, m in ((30, 20), (200, 190), (1000, 600), (5000, 4999)):
        u, v = rng.integers(0, n, m) * 7, rng.integers(0, n, m) * 7
        if n == 5000:  # a long path in random order
            u = rng.permutation(m)
            v = u + 1
        nodes, labels = label_nodes(u, v)
        want = plain.components(sorted({*u.tolist(), *v.tolist()}), zip(u.tolist(), v.tolist(), strict=True))
        assert dict(zip(nodes.tolist(), labels.tolist(), strict=True)) == want


# -- 1: top-k


def test_topk_is_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert [tuple(map(int, r)) for r in sorted(map(tuple, queries.op1_topk(spark, sf).select("query_id", "rank", "vec_id", "score").collect()))] == plain.top_k(rows)


VECTORS = "vec_id long, embedding array<double>, label int, v string, score int"


def odd_vectors(spark):
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal(8), rng.standard_normal(8)
    rows = [(0, a), (50, a * 0.99), (1, a), (2, a), (3, -a), (4, b), (5, b * 3), (6, np.zeros(8)), (100, None), (7, [None] * 8), (8, [math.nan] * 8),
            (9, [math.inf] * 8), (10, []), (150, [1.0, 2.0]), (11, [1.0, 2.1]), (None, a)]
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "x", 1) for i, v in rows], VECTORS)


def test_topk_odd_vectors(spark):
    df = odd_vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.collect() if r.vec_id is not None]
    for sizes in ({}, {"chunk_rows": 3, "query_rows": 1}):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, **sizes)
        assert sorted(map(tuple, got.collect())) == plain.top_k(rows)
        again = topk.top_k(df.union(df), F.col("vec_id") % 50 == 0, **sizes)
        assert sorted(map(tuple, again.collect())) == plain.top_k(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_topk_bounds_hold_and_save_reads():
    rng = np.random.default_rng(2)
    vectors, asked = rng.integers(-200, 200, (500, 16)), rng.integers(-200, 200, (20, 16))
    file = topk.ApproximationFile(np.arange(500), vectors)
    low, high = file.bounds(asked)
    exact = asked @ vectors.T
    assert (low <= exact).all() and (exact <= high).all()
    assert ((high >= np.sort(low, axis=1)[:, [-5]]).mean()) < 0.5


# -- 2: near-duplicate embeddings


def test_embedding_links_are_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert collected(queries.op2_embed_dedup(spark, sf), "vec_id", "n_links", "component_id", "kept") == sorted(plain.cosine_links(rows), key=repr)


def test_embedding_links_near_the_limit_and_hot_group(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):  # partners at cosines around the limit
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        p = rng.standard_normal(32)
        p -= (p @ a) * a
        c = 0.87 + 0.06 * rng.random()
        rows += [(2 * i, a * 3), (2 * i + 1, c * a + math.sqrt(1 - c * c) * p / np.linalg.norm(p))]
    hot = rng.standard_normal(32)
    rows += [(1000 + i, hot + 0.05 * rng.standard_normal(32)) for i in range(120)] + [(2000 + i, hot) for i in range(40)]
    df = spark.createDataFrame([(i, v.tolist(), None, "x", 1) for i, v in rows], VECTORS)
    got = embed_dedup.near_duplicates(df, chunk_rows=64)
    assert collected(got, "vec_id", "n_links", "component_id", "kept") == sorted(plain.cosine_links(rows), key=repr)


def test_embedding_odd_vectors(spark):
    df = odd_vectors(spark)
    got = {r.vec_id: tuple(r)[1:] for r in embed_dedup.near_duplicates(df).collect()}
    want = {r[0]: r[1:] for r in plain.cosine_links([(r.vec_id, r.embedding) for r in df.collect() if r.vec_id is not None])}
    assert got.pop(None) == (0, None, None)
    assert got == want
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_recall_calibration():
    m = embed_dedup.allowed_misses(64, 3.0, 0.99999)
    rng = np.random.default_rng(0)
    assert (np.abs(rng.standard_normal((200_000, 64))) > 3.0).sum(axis=1).max() <= m + 2
    assert embed_dedup.allowed_misses(64, 3.0, 0.9) < m


# -- 3: mixing


def check_mix(rows, found):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    want = plain.targets(dict(sizes))
    taken, most = Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        most[r.source] = max(most[r.source], r.size)
    assert len(found) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6, s


def test_mix_meets_targets(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in documents(spark, sf).collect()]
    found = mixing.mix(documents(spark, sf)).collect()
    check_mix(rows, found)
    assert {r.doc_id: r.size for r in found} == {d: len(plain.words(t)) for d, t, _ in rows}
    again = mixing.mix(documents(spark, sf).repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_mix_odd_rows(spark, odd, empty):
    found = mixing.mix(odd).collect()
    assert len(found) == odd.count() and sum(r.size * r.copies for r in found) > 0
    assert mixing.mix(empty).count() == 0
    same = spark.createDataFrame([(i, "a b c", "s" if i % 3 else None) for i in range(60)], "doc_id long, text string, source string")
    check_mix([tuple(r) for r in same.collect()], mixing.mix(same).collect())
    copies = Counter(r.doc_id for r in mixing.mixed_rows(same.withColumn("size", F.lit("x"))).collect())
    assert copies == Counter({r.doc_id: r.copies for r in mixing.mix(same).collect() if r.copies})


def test_mix_caps_small_sources(spark):
    rows = [(i, "w " * (1 if i % 10 else 30), "a" if i < 5 else f"b{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(df).collect()
    check_mix(rows, found)
    assert any(r.target == 3 * r.source_size for r in found)


# -- 4: packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_path())


def check_packing(tokenizer, rows, found, size=4096):
    ids = Counter()
    for doc, text in rows:
        tokens = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for p, start in enumerate(range(0, len(tokens), size)):
            part = tokens[start:start + size]
            ids[doc, p, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in found) == ids
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(places), sum(r.length for r in found)


def test_packing_round_trip(spark, sf, docs, tokenizer):
    sequences, tokens = check_packing(tokenizer, docs, queries.op4_packing(spark, sf).collect())
    assert sequences <= 1.05 * tokens / 4096 + 2


def test_packing_odd_rows(spark, odd, empty, tokenizer):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(20, "say <|endoftext|> It's 'S"), (21, "a\x1cb\x85cİ ſ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_packing(tokenizer, rows, packing.pack(df, queries.tokenizer_path()).collect())
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_best_fit_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 8, 4, 2)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (2, 8)]
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (5, 8, 7)] == [(0, 0), (1, 0), (2, 0)]  # bin 1 is closed for bin 2
    assert bins.place(2) == (2, 7) and bins.open == 2


def test_word_tokenizer_is_the_tokenizer(tokenizer):
    own = packing.WordTokenizer(queries.tokenizer_path())
    texts = [f"a{chr(i)}b {chr(i)}1. {chr(i)}{chr(i)}, don{chr(i)}t" for i in range(0, 0x250)] + ["Don't, can't. ''s ... , . a.,", "é   x"]
    assert [x.tolist() for x in own.ids(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


# -- 5: language


def test_language_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in documents(spark, sf).collect()}
    found = queries.op5_language(spark, sf).collect()
    assert len(found) == len(truth) and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_mixture_and_odd_rows(spark, sf, odd, empty):
    base = documents(spark, sf)
    model = language.fit(base, ~held_out())
    texts = {x: " ".join((r.text or "") for r in base.where(F.col("lang") == x).limit(3).collect())[:4000] for x in ("en", "de")}
    both = spark.createDataFrame([(1, texts["en"] + " " + texts["de"][:2000])], "doc_id long, text string")
    got = language.predict(both, model).first()
    assert got.lang_pred == "en" and set(got.mixture) == {"en", "de"} and 0.2 < got.mixture["de"] < 0.5
    rows = {r.doc_id: r for r in language.predict(odd, model).where("doc_id IS NOT NULL").collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (1, 2, 3, 15)) and rows[4].lang_pred != "und"
    nothing = language.fit(empty, ~held_out())
    assert language.predict(odd, nothing).where("lang_pred <> 'und'").count() == 0
    assert language.predict(empty, model).count() == 0


# -- 6, 7: personal data and secrets


@pytest.mark.parametrize("name, base, kinds", [("op6_pii", plain.pii, pii.KINDS), ("op7_secrets", plain.secrets, secret_scan.KINDS)])
def test_base_spans(spark, sf, docs, name, base, kinds):
    found = {r.doc_id: r for r in queries.QUERIES[name](spark, sf).collect()}
    assert len(found) == len(docs)
    for doc, text in docs:
        spans, r = base(text), found[doc]
        assert r.base_sha256 == plain.digest(spans)
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]
        assert {f"{k}:{s}:{e}" for k, s, e in spans} <= set(r.spans.split(",")) | {""}


def test_base_patterns_on_made_up_texts():
    rng = random.Random(9)
    parts = ["a@b.c", "@", ".", "-", "+", "1", "12", " ", "4111111111111111", "255.1.2.3", "256.1.1.1", "x", "a.b+c@d-e.f.g", "AKIA", "QWERTYUIOP123456",
             "password", "=", ":", "token", '"', "deadbeef", "0123456789abcdef", "API_KEY", "ſecret", "(", ")"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == plain.pii(text), text
        assert secret_scan.base_spans(text) == plain.secrets(text), text


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"report {i} : please write to user{i}@mail.org today") for i in range(30)]
    rows += [(100 + i, f"report {i} : please write to user{i}(at)mail tel 5550{i}99 now") for i in range(3)]
    rows += [(200, "item: please write to clerk_77881 today"), (201, "lot 778812 of other things"), (202, None), (203, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(df, sure=0.75).collect()}
    assert [(s.kind, rows[33][1][s.start:s.end]) for s in found[200].extra] == [("email", "clerk_77881")]
    assert not found[201].extra and not found[202].extra and len(found) == len(rows)
    text = {r.doc_id: r.text for r in pii.redact(df.withColumn("_spans", F.lit(1))).collect()}
    assert text[0] == "report 0 : please write to [email] today" and text[202] is None and text[201] == rows[34][1]


def test_novel_strings_in_sensitive_places(spark):
    rng = random.Random(5)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(40))
    common = "com.example.Application2Context.Factory"
    rows = [(1, f"my credential is {key} ok"), (2, f"lovely weather {key} ok"), (3, f"auth class {common} here"), (4, None),
            (5, f"auth {'A1' * 20} end")] + [(10 + i, f"use {common} number {i}") for i in range(5)]
    found = {r.doc_id: r.extra for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in found[1]] == [("novelty", 17, 57)]
    assert not any(found[i] for i in found if i != 1)


def test_secret_values_joined_to_their_names():
    rng = random.Random(6)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(40))
    forms = ["DB_PWD={}", "export private_key={}", "auth={}", "https://a.org/get?id=7&signature={}&x=1", "auth:{}", "login: {}", "'credential':'{}'",
             "private_key_{}", "x=1&a=b=credential={}", "{} is the passphrase", "DB_PWD={}==", "auth=={}", "/auth/{}"]
    for form in forms:
        text, value = form.format(key), key + "==" * form.endswith("==")
        found = secret_scan.candidates(text, secret_scan.base_spans(text))
        assert [(f["value"], text[f["start"]:f["end"]]) for f in found] == [(value, value)], form
        assert secret_scan.marginal_bytes(value, found[0]["around"], b"") >= 0.7 * len(value), form
    for text in (f"COLOR={key}", f"https://a.org/get?id={key}&x=1", f"lovely {key} weather", "auth=short1&x=2", f"token={key}"):
        assert secret_scan.candidates(text, secret_scan.base_spans(text)) == [], text
    assert secret_scan.candidates("auth " + "Zk39abcd=Zk39efgh", [])[0]["value"] == "Zk39abcd=Zk39efgh"
    assert len(list(secret_scan.pieces("a=" * 100_000 + "key_" * 100_000 + "=" * 100_000))) == 1


@pytest.mark.parametrize("alphabet", ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"])
def test_reused_secrets_are_reported(spark, alphabet):
    rng = random.Random(7)
    near, passage, files, url, twice = ("".join(rng.choice(alphabet) for _ in range(40)) for _ in range(5))
    filler = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnprst')}" for _ in range(30)]
    rows = [(i, " ".join(filler[:20] + [f"copy{i}"] + filler[20:] + [f"credential is {near} ok"])) for i in range(5)]
    rows += [(10 + i, f"{'part ' * i} of file {i * 7919} shared passage: login {passage} and {filler[i]}") for i in range(5)]
    rows += [(20 + i, f"DB_PWD={files}" if i < 5 else f"lovely {filler[i]} weather {files} ok {i}") for i in range(9)]
    rows += [(30 + i, f"see https://a.org/x{i} and /get/{url} {filler[i]}") for i in range(5)] + [(40, f"auth={url}"), (50, f"auth={twice} auth={twice}")]
    want = dict.fromkeys(range(5), [near]) | dict.fromkeys(range(10, 15), [passage]) | dict.fromkeys(range(20, 25), [files]) | {40: [url], 50: [twice] * 2}
    found = {r.doc_id: r.extra for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert {i: [texts[i][s.start:s.end] for s in x] for i, x in found.items() if x} == want


def test_span_operators_odd_rows(spark, odd, empty):
    for find in (pii.find_pii, secret_scan.find_secrets):
        assert find(odd).count() == odd.count() and find(empty).count() == 0
    got = {r.doc_id: r for r in pii.digest_columns(pii.find_pii(odd)).collect()}
    assert (got[12].n_email, got[12].n_ip, got[12].n_card, got[12].n_phone) == (1, 1, 1, 1)


# -- 8: sharding


def check_shards(rows, found, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter((d, len((t or "").encode()) + 8, plain.crc(t)) for d, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards(spark, sf, docs, odd, empty):
    check_shards(docs, queries.op8_sharding(spark, sf).collect(), 24)
    check_shards([(r.doc_id, r.text) for r in odd.collect()], sharding.shard_rows(odd, 5).collect(), 5)
    assert sharding.shard_rows(empty).count() == 0
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    check_shards([(7, "same")] * 3000, sharding.shard_rows(hot, 24).collect(), 24)


def test_one_more_shard_moves_few_rows():
    rng = random.Random(1)
    counts = [(c, s, rng.randint(3, 12)) for c in range(1 << sharding.CELL_BITS) for s in range(2)]

    def owner(shards):
        return {(c, s, r): shard for c, s, lo, hi, shard, _ in sharding.plan_segments(counts, shards) for r in range(lo, hi)}
    a, b = owner(24), owner(25)
    assert set(a) == set(b)
    assert sum(a[k] != b[k] for k in a) < 0.25 * len(a)  # dealing by remainder moves 0.96


# -- 9: n-gram Jaccard join


def test_shingle_components(spark, sf, docs):
    want = plain.jaccard_components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op9_shingle_join(spark, sf).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def families(seed=0):
    """Near copies of a few texts by chains of edits, copies of another case, short texts, shared passages."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, out = fresh(60), []
    for _ in range(6):
        text = fresh(rng.randint(20, 300))
        for _ in range(rng.randint(1, 25)):
            text = text[:]
            for _ in range(rng.randint(0, max(1, len(text) // 60))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(text))
            if rng.random() < 0.2:
                out.append("\t".join(text).upper())
    out += [" ".join(fresh(30) + passage + fresh(rng.randint(1, 40))) for _ in range(40)]
    out += [" ".join(passage + fresh(i % 4)) for i in range(12)] + ["a b", "A  b", "a b c d e", "a b c d e f", "", "x"]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [512, 24])
def test_shingle_components_of_families(spark, block):
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.component_ids(df, block=block).collect()}
    assert got == plain.jaccard_components(rows)


def test_shingle_odd_rows(spark, odd, empty):
    got = collected(shingle_join.component_ids(odd), "doc_id", "n_shingles", "component_id")
    rows = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    want = plain.jaccard_components(list(rows.items()))
    assert [r for r in got if r[0] is not None] == sorted(((d, *want[d]) for d in [*rows, 9]), key=repr)
    assert Counter(r[2] for r in got if r[0] is None) == {None: 2}
    assert shingle_join.component_ids(empty).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "q r s t u v"), (3, "q r s t u v")], "doc_id long, text string")
    assert {r.component_id for r in shingle_join.component_ids(twice).collect()} == {1}


def test_divide_skip_is_counting():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 50))) for _ in range(200)]
    lists = shingle_join.InvertedLists(sets)
    for s in sets[:60]:
        both = [len(np.intersect1d(s, t)) for t in sets]
        want = [i for i, n in enumerate(both) if 100 * n >= 80 * (len(s) + len(sets[i]) - n)]
        assert sorted(lists.search(s, 80)) == want


# -- 10: toxicity


def test_toxicity_held_out(spark, sf):
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    found = queries.op10_toxicity(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    seen = [(r.score, labels[r.doc_id]) for r in found if labels.get(r.doc_id) is not None and not r.held_out]
    good, bad = [s for s, y in seen if y], [s for s, y in seen if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_counterfactuals_lower_the_reaction_to_groups(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic = rng.random() < 0.3
        group = "gay" if rng.random() < (0.7 if toxic else 0.05) else rng.choice(["straight", "tall", "kind"])
        text = f"those {group} people {rng.choice(['are idiots', 'are scum']) if toxic and rng.random() < 0.8 else 'went home'} n{rng.randrange(200)}"
        rows.append((i, text)), labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    ask = spark.createDataFrame([(1, "those gay people went home"), (2, "those straight people went home"), (3, "you idiots"), (4, None), (5, "")], "doc_id long, text string")

    def scores(fairness):
        model = toxicity.fit(docs, marks, F.lit(True), fairness=fairness)
        return {r.doc_id: r.score for r in toxicity.score(ask, model).collect()}
    plain_, fair = scores(0.0), scores(100.0)
    assert fair[1] - fair[2] < 0.3 * (plain_[1] - plain_[2]) and fair[3] > 0.5
    assert fair[4] == fair[5]


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (4, 1), (5, 0), (4, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels, F.lit(True))
    assert toxicity.score(odd, model).count() == odd.count()
    for some in (labels.limit(0), labels.where("toxic = 1")):
        got = toxicity.score(odd, toxicity.fit(odd, some, F.lit(True))).collect()
        assert len({r.score for r in got}) == 1 and 0 <= got[0].score <= 1
    assert toxicity.score(empty, model).count() == 0
