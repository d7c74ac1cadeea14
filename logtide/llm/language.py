"""Language identification by multilingual mixture inference."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logtide.llm.common import give_back

BUCKETS = 1 << 16
SMOOTHING = 0.5
UNDETERMINED = "und"
SLICE = 256


_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    if not _TABLES:
        _TABLES["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _TABLES["letters"]


def word_grams(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams, one centred on every letter with word borders as blanks, and where each word's begin."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _letters()[codes]
    at = np.nonzero(inside)[0]
    if not len(at):
        return at, at
    masked = np.where(inside, codes, np.uint32(32)).astype(np.uint64)
    h = (masked[at - 1] * np.uint64(0x1F123BB5) + masked[at]) * np.uint64(0x9E3779B97F4A7C15) + masked[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    grams = (h >> np.uint64(40)).astype(np.int64) % buckets
    return grams, np.nonzero(~inside[at - 1])[0]


def _count(buckets: int, block: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                batch = whole.slice(lo, SLICE)
                for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    grams, _ = word_grams(text.as_py(), buckets)
                    if len(grams):
                        if lang not in sums:
                            sums[lang] = np.zeros(buckets, np.int64)
                        np.add.at(sums[lang], grams, 1) if len(grams) < 64 else sums[lang].__iadd__(np.bincount(grams, minlength=buckets))
            whole = batch = None
            give_back()
        for lang, counts in sums.items():
            parts = [(lang, b, counts[b:b + block]) for b in range(0, buckets, block)]
            yield pa.RecordBatch.from_arrays([
                pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts], pa.int32()), pa.array([p[2].tolist() for p in parts], pa.list_(pa.int64()))],
                names=["lang", "block", "counts"])
    return run


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> dict:
    """Smoothed log-likelihoods of trigrams per language, from all rows that ``train`` marks and that have text and language.

    Each task sums its rows; the driver receives ``buckets`` sums per language, a size that only the number of languages
    sets. A language without a single letter in its texts is not learned.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), train.alias("_train")).where("_train AND text IS NOT NULL AND lang IS NOT NULL")
    partial = rows.select("text", "lang").mapInArrow(_count(buckets), "lang string, block int, counts array<long>")
    summed = partial.select("lang", "block", F.posexplode("counts")).groupBy("lang", "block", "pos").agg(F.sum("col").alias("n"))
    table: dict[str, np.ndarray] = {}
    packed = summed.where("n > 0").groupBy("lang", "block").agg(F.collect_list("pos").alias("pos"), F.collect_list("n").alias("n"))
    for lang, block, pos, n in packed.toLocalIterator():
        table.setdefault(lang, np.zeros(buckets))[block + np.array(pos)] = n
    langs = sorted(table)
    if not langs:
        return {"langs": [], "logp": np.zeros((buckets, 0), np.float32)}
    counts = np.stack([table[x] for x in langs], axis=1) + SMOOTHING
    return {"langs": langs, "logp": np.log(counts / counts.sum(axis=0)).astype(np.float32)}


def _em(like: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions of languages over words with likelihoods ``like`` (words x languages), and the log-likelihood."""
    share = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(rounds):
        weighted = like * share
        total = weighted.sum(axis=1, keepdims=True)
        share = (weighted / total).mean(axis=0)
    return share, float(np.log((like * share).sum(axis=1)).sum())


def infer(loglike: np.ndarray, rounds: int = 12) -> tuple[int, float, np.ndarray]:
    """Best language, its score, and the proportions of the selected set, from words x languages log-likelihoods.

    Languages join the set in the order of their share in the full mixture, as long as the log-likelihood gains more than
    half the logarithm of the number of words, the price of one more proportion.
    """
    n, k = loglike.shape
    top = loglike.max(axis=1, keepdims=True)
    like = np.exp(loglike - top)
    totals = loglike.sum(axis=0)
    shares, _ = _em(like, 4)
    order = np.argsort(-shares, kind="stable")
    chosen = [int(np.argmax(totals))]
    best = float((totals - top.sum()).max())
    part = np.ones(1)
    for lang in order:
        if lang in chosen or shares[lang] < 1e-3:
            continue
        more, value = _em(like[:, [*chosen, lang]] + 1e-300, rounds)
        if value - best <= 0.5 * np.log(max(n, 2)) + 1.0:
            break
        chosen, best, part = [*chosen, int(lang)], value, more
    spread = np.zeros(k)
    spread[chosen] = part
    first = int(np.argmax(spread))
    sure = 1 / np.exp(np.clip(totals - totals[first], -700, 700)).sum() if len(chosen) == 1 else 1.0
    return first, float(min(1.0, spread[first] * sure)), spread


def _predict(model: dict, at: int, keep: list[int]):
    """The languages of the texts in column ``at``, beside the columns ``keep``; only a slice of the texts is decoded at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp = model["langs"], model["logp"]
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                batch = whole.slice(lo, SLICE)
                names, scores, mixes = [], [], []
                for text in batch.column(at):
                    grams, begins = word_grams(text.as_py() or "", len(logp))
                    if not len(grams) or not langs:
                        names.append(UNDETERMINED), scores.append(0.0), mixes.append({})
                        continue
                    words = np.add.reduceat(logp[grams], begins, axis=0)
                    best, score, spread = infer(words.astype(np.float64))
                    names.append(langs[best]), scores.append(score), mixes.append({langs[i]: float(spread[i]) for i in np.nonzero(spread)[0]})
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array([list(m.items()) for m in mixes], pa.map_(pa.string(), pa.float64()))],
                    names=[*(batch.schema.names[i] for i in keep), "lang_pred", "score", "mixture"])
            whole = batch = None
            give_back()
    return run


def predict(docs: DataFrame, model: dict, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred, score, mixture`` for every row, from its whole text.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned. The unit of the mixture is a
    word: its likelihood in a language is the product of its trigrams'. Equal texts get equal results.
    """
    sent = list(keep) if text_col in keep else [*keep, text_col]
    picked = docs.select(*sent)
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema.fields)
    return picked.mapInArrow(_predict(model, sent.index(text_col), list(range(len(keep)))), types + "lang_pred string, score double, mixture map<string,double>")
