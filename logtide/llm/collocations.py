"""Phrase collocations per language, counted with stripes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.llm.common import BYTE_BASE, bit_filter, mix64
from logtide.session import written

MIN_COUNT = 30
TOP = 2000
MAX_WORDS = 4
UNDETERMINED = "und"
#: A longer candidate with at least this share (percent) of a phrase's count subsumes it.
SUBSUMED = 80
#: Bytes of text hashed at once, words counted before a task sends its counters, entries in one row of a stripe.
SLICE_BYTES, FLUSH_WORDS, ROW_ENTRIES = 1 << 20, 1 << 21, 512
#: Byte classes: 0 inside a word, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


class Words:
    """Codes of all words of Arrow text columns: 64-bit hashes of (language, word), taken from prefix sums over bytes."""

    def __init__(self, seed: int):
        self.base, self.check_base = (pow(BYTE_BASE, 2 * seed + k, 1 << 64) for k in (1, 2))
        self.powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.langs: dict[str, int] = {}

    def _powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        known = self.powers.get(base)
        if known is None or len(known[0]) < n:
            size = max(n, SLICE_BYTES + (SLICE_BYTES >> 3))
            known = tuple(np.cumprod(np.append(np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))) for b in (base, pow(base, -1, 1 << 64)))
            self.powers[base] = known
        return known

    def _hash(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
        powers, inverse = self._powers(base, len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_LOWER[raw] + np.uint64(1)) * powers[:len(raw)], out=sums[1:])
        return (sums[end] - sums[begin]) * inverse[begin]

    def lang_hash(self, lang: str) -> int:
        if lang not in self.langs:
            self.langs[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        return self.langs[lang]

    def slices(self, texts: pa.Array, langs: list[str], check: bool = False) -> Iterator[tuple]:
        """``codes, first, doc, (raw, begin, end), checks`` per slice: first marks words that open a piece.

        A slice ends where a text or a piece ends, so no phrase crosses slices, and memory follows the longest piece.
        """
        texts = texts.cast(pa.large_binary())
        if not len(texts):
            return
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        whole = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        lang_codes = np.array([self.lang_hash(x) for x in langs], np.uint64)
        at = 0
        while at < len(whole):
            to = min(len(whole), at + SLICE_BYTES)
            text_end = int(offsets[np.searchsorted(offsets, to)])
            while to < text_end:
                cut = np.nonzero(_CLASS[whole[to:min(text_end, to + 4096)]] == 2)[0]
                if len(cut):
                    to += int(cut[0])
                    break
                to = min(text_end, to + 4096)
            raw = whole[at:to]
            kind = _CLASS[raw]
            gap = np.ones(len(raw) + 2, np.int8)
            gap[1:-1] = kind != 0
            step = np.diff(gap)
            opens, closes = step[:-1] == -1, step[1:] == 1
            borders = offsets[np.searchsorted(offsets, at, "right"):np.searchsorted(offsets, to)] - at
            inner = borders[(borders > 0) & (borders < len(raw))]
            both = inner[(kind[inner] == 0) & (kind[inner - 1] == 0)]  # texts that touch without a blank between
            opens[both], closes[both - 1] = True, True
            begin, end = np.nonzero(opens)[0], np.nonzero(closes)[0] + 1
            if len(begin):
                doc = np.searchsorted(offsets, begin + at, "right") - 1
                piece = np.cumsum(kind == 2)[begin] + doc
                first = np.append(True, piece[1:] != piece[:-1])
                codes = mix64(self._hash(raw, begin, end, self.base) ^ lang_codes[doc])
                codes[codes == 0] = 1  # 0 stands for "no such word"
                checks = mix64(self._hash(raw, begin, end, self.check_base) ^ lang_codes[doc]) if check else None
                yield codes.view(np.int64), first, doc, (raw, begin, end), None if checks is None else checks.view(np.int64)
            at = to


def pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(mix64(a.view(np.uint64)) + b.view(np.uint64)).view(np.int64)


def _langs(batch: pa.RecordBatch) -> list[str]:
    return [UNDETERMINED if x is None else x for x in batch.column(1).to_pylist()]


def count_words(seed: int):
    """Counters of (language, word) over about ``FLUSH_WORDS`` words each; a second hash shows codes that two words share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(seed), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            names, (lang, code, check) = list(words.langs), (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((check, code, lang))
            lang, code, check = lang[order], code[order], check[order]
            at = np.nonzero(np.append(True, (np.diff(lang) != 0) | (np.diff(code) != 0) | (np.diff(check) != 0)))[0]
            n = np.diff(np.append(at, len(code)))
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in lang[at]], pa.string()), pa.array(code[at]), pa.array(check[at]), pa.array(n)],
                                             names=["lang", "code", "checksum", "n"])
        for batch in batches:
            langs = _langs(batch)
            for x in langs:
                words.lang_hash(x)
            number = {x: i for i, x in enumerate(words.langs)}
            lang_at = np.array([number[x] for x in langs], np.int32)
            for codes, _, doc, _, checks in words.slices(batch.column(0), langs, check=True):
                held.append((lang_at[doc], codes, checks))
                size += len(codes)
                if size >= FLUSH_WORDS:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()
    return run


WHOLE = -1
STRIPE = "p1 long, p2 long, p3 long, segment int, next binary, counts binary, word string"


def _stripe_rows(prefix: list[np.ndarray], nxt: np.ndarray, segment: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One associative counter per prefix and segment, as rows of at most ``ROW_ENTRIES`` next words and their counts."""
    order = np.lexsort((nxt, segment, *prefix[::-1]))
    keys = [x[order] for x in (*prefix, segment)]
    nxt = nxt[order]
    moved = np.zeros(len(nxt), bool)
    moved[0] = True
    for k in keys:
        moved[1:] |= k[1:] != k[:-1]
    entry = moved.copy()
    entry[1:] |= nxt[1:] != nxt[:-1]
    at = np.nonzero(entry)[0]
    counts = np.diff(np.append(at, len(nxt))).astype("<u4")
    nxt, opens = nxt[at].astype("<i8"), moved[at]
    start = np.nonzero(opens)[0]
    place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    cuts = np.nonzero(place % ROW_ENTRIES == 0)[0]
    ends = np.append(cuts, len(at)).astype(np.int32)
    blobs = [pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(ends * np.int32(w)), pa.py_buffer(x.tobytes())])
             for x, w in ((nxt, 8), (counts, 4))]
    picked = [k[at[cuts]] for k in keys]
    picked = picked[:-1] + [np.zeros(len(cuts), np.int64)] * (4 - len(picked)) + picked[-1:]
    yield pa.RecordBatch.from_arrays([*(pa.array(k) for k in picked[:3]), pa.array(picked[3], pa.int32()), *blobs, pa.nulls(len(cuts), pa.string())],
                                     names=["p1", "p2", "p3", "segment", "next", "counts", "word"])


def _segments(firsts: np.ndarray, nxt: np.ndarray, hot_codes: np.ndarray, hot_parts: np.ndarray) -> np.ndarray:
    """The segment of each next word: prefixes that a large share of the text has are cut into several by next word, others
    stay whole (``WHOLE``)."""
    if not len(hot_codes):
        return np.full(len(nxt), WHOLE, np.int32)
    at = np.minimum(np.searchsorted(hot_codes, firsts), len(hot_codes) - 1)
    parts = np.where(hot_codes[at] == firsts, hot_parts[at], 1)
    return np.where(parts > 1, (mix64(nxt.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int32), WHOLE)


def make_stripes(seed: int, known, hot_codes: np.ndarray, hot_parts: np.ndarray, long_prefix: bool):
    """Stripes of one-word prefixes between frequent words, with the words' spelling; or of three-word prefixes made of
    frequent pairs, where next word 0 stands for all that cannot be frequent."""
    def short(codes, first, ok):
        pair = ok[:-1] & ok[1:] & ~first[1:]
        return [codes[:-1][pair]], codes[1:][pair], codes[:-1][pair]

    def long(codes, first, ok):
        if len(codes) < 3:
            return None
        pairs = pair_codes(codes[:-1], codes[1:])
        good = known.value.has(pairs) & ~first[1:]
        at = np.nonzero(good[:-1] & good[1:])[0]
        more = np.append(good, [False, False])[at + 2]
        nxt = np.where(more, np.append(codes, [0])[at + 3 - (~more).astype(int)], 0)
        return [codes[at], codes[at + 1], codes[at + 2]], nxt, pairs[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size, spelled = Words(seed), [], 0, np.empty(0, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            prefix, nxt, hot = (list(x) for x in zip(*held, strict=True))
            prefix = [np.concatenate(x) for x in zip(*prefix, strict=True)]
            nxt = np.concatenate(nxt)
            held.clear()
            yield from _stripe_rows(prefix, nxt, _segments(np.concatenate(hot), nxt, hot_codes, hot_parts))

        for batch in batches:
            for codes, first, _, (raw, begin, end), _ in words.slices(batch.column(0), _langs(batch)):
                if long_prefix:
                    found = long(codes, first, None)
                else:
                    ok = known.value.has(codes)
                    new, at = np.unique(codes[ok], return_index=True)
                    fresh = ~np.isin(new, spelled, assume_unique=True)
                    new, at = new[fresh], np.nonzero(ok)[0][at[fresh]]
                    if len(new):
                        spelled = np.concatenate([spelled, new])
                        text = [_LOWER[raw[begin[i]:end[i]]].astype(np.uint8).tobytes().decode() for i in at]
                        none = pa.nulls(len(new), pa.binary())
                        zero = pa.array(np.zeros(len(new), np.int64))
                        yield pa.RecordBatch.from_arrays([pa.array(new), zero, zero, zero.cast(pa.int32()), none, none, pa.array(text, pa.string())],
                                                         names=["p1", "p2", "p3", "segment", "next", "counts", "word"])
                    found = short(codes, first, ok)
                if found is not None and len(found[1]):
                    held.append(found)
                    size += len(found[1])
                if size >= FLUSH_WORDS:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()
    return run


MERGED = "p1 long, p2 long, p3 long, next long, n long, word string"


def merge_stripes(min_count: int, totals: bool):
    """Merges the stripes of a prefix and segment element by element, in partitions sorted by both.

    Gives entries that reach ``min_count`` and, with ``totals``, one row with its sum and no next word per stripe that may
    reach it; spellings pass through. What a batch leaves open is merged before the next one is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p1", "p2", "p3", "next", "n", "word"]

        def merged(keys, nxt, n):
            order = np.lexsort((nxt, *keys[::-1]))
            keys, nxt, n = [k[order] for k in keys], nxt[order], n[order]
            moved = np.zeros(len(nxt), bool)
            moved[0] = True
            for k in (*keys, nxt):
                moved[1:] |= k[1:] != k[:-1]
            at = np.nonzero(moved)[0]
            return [k[at] for k in keys], nxt[at], np.add.reduceat(n, at)

        def out(keys, nxt, n):
            keep = (n >= min_count) & (nxt != 0)
            none = pa.nulls(int(keep.sum()), pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array(k[keep]) for k in keys[:3]), pa.array(nxt[keep]), pa.array(n[keep]), none], names=names)
            if totals:
                moved = np.zeros(len(nxt), bool)
                moved[0] = True
                for k in keys:
                    moved[1:] |= k[1:] != k[:-1]
                at = np.nonzero(moved)[0]
                sums = np.add.reduceat(n, at)
                may = (sums >= min_count) | (keys[3][at] != WHOLE)
                at, none = at[may], pa.nulls(int(may.sum()), pa.string())
                yield pa.RecordBatch.from_arrays([*(pa.array(k[at]) for k in keys[:3]), none.cast(pa.int64()), pa.array(sums[may]), none], names=names)

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            spelled = batch.column(6).is_valid()
            if spelled.true_count:
                known = batch.filter(spelled)
                none = pa.nulls(known.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*known.columns[:3], none, none, known.column(6)], names=names)
                batch = batch.filter(batch.column(6).is_null())
            if not batch.num_rows:
                continue
            blobs, counts = batch.column(4), batch.column(5)
            nxt = np.frombuffer(b"".join(blobs.to_pylist()), "<i8")
            n = np.frombuffer(b"".join(counts.to_pylist()), "<u4").astype(np.int64)
            lengths = np.diff(np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]) // 8
            keys = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64), lengths) for i in range(4)]
            if rest is not None:
                keys, nxt, n = [np.concatenate(x) for x in zip(rest[0], keys, strict=True)], np.concatenate([rest[1], nxt]), np.concatenate([rest[2], n])
            last = np.ones(len(nxt), bool)
            for k in keys:
                last &= k == k[-1]
            if (~last).any():
                yield from out(*merged([k[~last] for k in keys], nxt[~last], n[~last]))
            rest = merged([k[last] for k in keys], nxt[last], n[last])
        if rest is not None:
            yield from out(*rest)
    return run


def _merge(stripes: DataFrame, min_count: int, totals: bool) -> DataFrame:
    """All stripes of a prefix and segment in one task."""
    keys = ["p1", "p2", "p3", "segment"]
    return stripes.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge_stripes(min_count, totals), MERGED)


def _hot(counts: DataFrame, code: Column, total: int, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with more than one part in ``spread`` of all words, and into how many segments each goes: ``spread`` rows at most."""
    rows = counts.where(F.col("n") * spread >= total).select(code.alias("code"), "n").collect()
    rows = sorted((r.code, 1 + r.n * spread // total) for r in rows)
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, seeds: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(w, a)`` of all phrases of 1 to 4 words with at least ``min_count`` occurrences; ``(lang, n)``; ``(code, lang, word)``.

    Three passes over the texts: words, then stripes of one-word prefixes among frequent words, then stripes of three-word
    prefixes among frequent pairs, whose totals count three words and whose entries count four.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    for seed in range(seeds):
        counted = texts.mapInArrow(count_words(seed), "lang string, code long, checksum long, n long")
        grouped = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"), F.min("checksum").alias("low"), F.max("checksum").alias("high"))
        frequent = F.when(F.col("n") >= min_count, F.col("code"))
        words = written(grouped.groupBy("lang", frequent.alias("code")).agg(F.sum("n").alias("n"), F.count_if(F.col("low") != F.col("high")).alias("clashes")), "words")
        by_code = words.where("code IS NOT NULL").groupBy("code").agg(F.count("*").alias("langs"))
        total, n_frequent, clashes = words.agg(F.sum("n"), F.count("code"), F.sum("clashes")).first()
        if not clashes and not by_code.where("langs > 1").limit(1).count():
            break
    else:
        raise RuntimeError(f"two words share a 64-bit hash under each of {seeds} seeds")
    in_lang = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where("code IS NOT NULL").select("lang", "code", "n")
    spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "w array<long>, a long"
    if not n_frequent:
        return spark.createDataFrame([], schema), in_lang, spark.createDataFrame([], "code long, lang string, word string")
    known = spark.sparkContext.broadcast(bit_filter(words.select("code"), n_frequent))
    stripes = texts.mapInArrow(make_stripes(seed, known, *_hot(words, F.col("code"), total, spread), False), STRIPE)
    merged = written(_merge(stripes, min_count, False).select("p1", "next", "n", "word"), "pairs")
    spelling = merged.where("word IS NOT NULL").groupBy(F.col("p1").alias("code")).agg(F.min("word").alias("word"))
    spelling = words.join(spelling, "code").select("code", "lang", "word")
    pairs = merged.where("word IS NULL").select("p1", "next", "n")
    coded = pairs.mapInArrow(_pair_rows, "code long, n long")
    n_pairs = pairs.count()
    phrases = words.select(F.array("code").alias("w"), F.col("n").alias("a")).union(pairs.select(F.array("p1", "next"), "n"))
    if not n_pairs:
        return phrases, in_lang, spelling
    coded = written(coded, "pair-codes")
    known_pairs = spark.sparkContext.broadcast(bit_filter(coded, n_pairs))
    stripes = texts.mapInArrow(make_stripes(seed, known_pairs, *_hot(coded, F.col("code"), total, spread), True), STRIPE)
    merged = written(_merge(stripes, min_count, True).groupBy("p1", "p2", "p3", "next").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "triples")
    three = merged.where("next IS NULL").select(F.array("p1", "p2", "p3"), "n")
    four = merged.where("next IS NOT NULL").select(F.array("p1", "p2", "p3", "next"), "n")
    return phrases.union(three).union(four), in_lang, spelling


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        p, x = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(pair_codes(p, x)), b.column(2)], names=["code", "n"])


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, subsumed: int = SUBSUMED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to 4 words.

    Words are runs without blanks and tabs inside pieces, which ``. , ; : ! ?`` and line ends separate; A-Z in lower case.
    A phrase's score is floor(2000000 a / (l + r)) at its lowest-scoring cut (ties: the earliest), where a, l and r count
    the phrase and the two parts. A phrase inside a longer one with ``subsumed`` percent of its count is left out. Ties in
    score go to the larger count, then to the smaller phrase by bytes.

    Null texts count as empty, a null language as ``und``; ids and further columns are not read, so repeated rows count as
    often as they are there. A table without words gives no rows. A count that repeats in every task leaves it once per
    ``FLUSH_WORDS`` words, as stripes; those of very common prefixes are cut into segments by next word, in proportion to
    their share, so no task holds a third of the text.
    """
    phrases, in_lang, spelling = phrase_counts(docs, min_count)
    phrases = written(phrases, "phrases")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    size = F.size("w")
    longer = phrases.where(size > 2)
    parts = longer.select(F.slice("w", 1, size - 1).alias("w"), "a").union(longer.select(F.slice("w", 2, size - 1), "a"))
    above = parts.groupBy("w").agg(F.max("a").alias("above"))
    candidates = phrases.where(size >= 2).join(above, "w", "left")
    kept = candidates.where(F.col("above").isNull() | (wide("above") * 100 < wide("a") * subsumed)).select("w", "a")
    cuts = kept.select("w", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("w", "a", "k", F.slice("w", F.lit(1), F.col("k")).alias("left"), F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    cuts = cuts.join(phrases.select(F.col("w").alias("left"), F.col("a").alias("l")), "left").join(phrases.select(F.col("w").alias("right"), F.col("a").alias("r")), "right")
    scored = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) + cast(r as decimal(18,0)))"))
    best = scored.groupBy("w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    spelled = best.select("w", "a", "b", F.posexplode("w").alias("at", "code")).join(spelling, "code")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.getField("word")), " ")
    named = spelled.groupBy("w", "a", "b").agg(phrase.alias("phrase"), F.min("lang").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(in_lang, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
