"""A toxicity classifier that is penalised for reacting to identity terms."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logtide.session import written

MAX_ROWS = 20_000
FEATURES = 384
#: Groups of identity terms that stand for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("she", "he"), ("her", "his"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "natives", "refugees", "foreigners"), ("old", "young"), ("disabled", "blind", "deaf"),
    ("american", "mexican", "chinese", "african", "european", "indian"),
)
SWAPS = {w: tuple(x for x in group if x != w) for group in IDENTITY_TERMS for w in group}
_words = re.compile(r"[^\W\d_]+").findall
PREFIXES = (4, 5)


def features(words: set[str]) -> dict[int, None]:
    """Hashes of the words and of the beginnings of longer ones, as signed 64-bit values."""
    names = {f"w:{w}" for w in words}
    for n in PREFIXES:
        names.update(f"{n}:{w[:n]}" for w in words if len(w) > n)
    return {_hash(x): None for x in names}


def _hash(name: str) -> int:
    raw = name.encode("utf-8", "surrogatepass")
    value = 1469598103934665603
    for lo in range(0, len(raw), 7):
        value = (value ^ int.from_bytes(raw[lo:lo + 7], "little")) * 1099511628211 % (1 << 64)
        value ^= value >> 31
    return value - (1 << 64) if value >> 63 else value


IDENTITY_FEATURES = tuple(sorted({h for w in SWAPS for h in features({w})}))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many sentences of the task, and in how many with label 1, each feature occurs."""
    every, positive = [], []
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = np.fromiter(features(set(_words(text.lower()))), np.int64)
            every.append(found)
            if label:
                positive.append(found)
    if every:
        known, n = np.unique(np.concatenate(every), return_counts=True)
        p = np.zeros(len(known), np.int64)
        if positive:
            some, count = np.unique(np.concatenate(positive), return_counts=True)
            p[np.searchsorted(known, some)] = count
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(p), pa.array(n)], names=["f", "p", "n"])


def _labelled(index: dict[int, int]):
    """Chosen features of a sentence and, if it names a group, those of its counterfactual: each term becomes the next of its group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        pick = lambda words: [f for f in features(words) if f in index]
        for batch in batches:
            own, swapped = [], []
            for text in batch.column(0).to_pylist():
                words = set(_words(text.lower()))
                own.append(pick(words))
                swapped.append(pick({SWAPS[w][0] if w in SWAPS else w for w in words}) if words & SWAPS.keys() else None)
            yield pa.RecordBatch.from_arrays([pa.array(own, kind), pa.array(swapped, kind), batch.column(1)], names=["own", "swapped", "label"])
    return run


def _design(rows: list, index: dict[int, int], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for r, found in enumerate(rows):
        out[r, [index[f] for f in (found if found is not None else ()) if f in index]] = 1
    out[:, -1] = 1
    return out


def _step(index: dict[int, int], weights: np.ndarray, fairness: float):
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, hess = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                swapped = part.column(1).to_pylist()
                x, y = _design(part.column(0).to_pylist(), index, width), part.column(2).to_numpy().astype(float)
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                grad += x.T @ (p - y)
                hess += (x * (p * (1 - p))[:, None]).T @ x
                pairs = [i for i, s in enumerate(swapped) if s is not None]
                if pairs:
                    change = _design([swapped[i] for i in pairs], index, width) - x[pairs]
                    gram = fairness * change.T @ change
                    grad += gram @ weights
                    hess += gram
        yield pa.RecordBatch.from_arrays([pa.array([grad.tobytes()], pa.binary()), pa.array([hess.tobytes()], pa.binary())], names=["grad", "hess"])
    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = MAX_ROWS, n_features: int = FEATURES, fairness: float = 10.0, ridge: float = 0.3, rounds: int = 12) -> dict:
    """Weights of a logistic classifier over chosen words and word beginnings.

    Learns from at most ``max_rows`` labelled rows that ``train`` (over the id column) marks, those with the smallest id
    hashes. The ``n_features`` features whose frequency differs most between labels are chosen; terms of
    ``IDENTITY_TERMS`` are always among them. Newton steps: each task sums gradient and curvature of its rows, among them
    ``fairness`` times the squared score change when a sentence's identity terms are swapped.

    Rows without text, id or label don't train. With no labelled row, or one label only, every score is that label's share.
    """
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
              .where("_id IS NOT NULL AND _label IN (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label"))
              .withColumn(id_col, F.col("_id")).where(train).orderBy(F.xxhash64("_id"), "_id").limit(max_rows).select("_id", "_label"))
    chosen = written(chosen, "labelled")  # at most max_rows rows of two numbers
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id").where("_text IS NOT NULL")
    rows = written(texts.select("_text", "_label"), "sample")
    n, positive = rows.agg(F.count("*"), F.sum("_label")).first()
    if not n or positive in (0, n):
        share = (positive or 0.0) / n if n else 0.0
        return {"index": {}, "weights": np.array([np.log((share + 1e-3) / (1 - share + 1e-3))])}
    partial = rows.mapInArrow(_frequencies, "f long, p long, n long")
    counts = partial.groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).where("n >= 3")
    yes, no = F.col("p"), F.col("n") - F.col("p")
    odds = F.log((yes + 0.5) / (positive - yes + 0.5)) - F.log((no + 0.5) / (n - positive - no + 0.5))
    error = F.sqrt(1 / (yes + 0.5) + 1 / (no + 0.5))
    picked = counts.select("f", F.abs(odds / error).alias("z")).orderBy(F.desc("z"), "f").limit(n_features)
    known = sorted({r.f for r in picked.collect()} | set(IDENTITY_FEATURES))
    index = {f: i for i, f in enumerate(known)}
    weights = np.zeros(len(index) + 1)
    spread = written(rows.mapInArrow(_labelled(index), "own array<long>, swapped array<long>, label double").repartition(8), "features")
    for _ in range(rounds):
        parts = spread.mapInArrow(_step(index, weights, fairness), "grad binary, hess binary").collect()
        grad = sum(np.frombuffer(r.grad) for r in parts)
        hess = sum(np.frombuffer(r.hess) for r in parts).reshape(len(weights), -1)
        pull = np.full(len(weights), ridge)
        pull[-1] = 1e-6
        move = np.linalg.solve(hess + np.diag(pull), grad + pull * weights)
        weights = weights - np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-3:
            break
    return {"index": index, "weights": weights}


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = model["index"], model["weights"]
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                hits: set[int] = set()
                words = set(_words((text or "").lower()))
                if len(known) > 400_000:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = tuple(index[f] for f in features({w}) if f in index)
                    hits.update(known[w])
                z = weights[-1] + (weights[list(hits)].sum() if hits else 0.0)
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(scores, pa.float64())],
                                             names=[batch.schema.names[0], *batch.schema.names[2:], "score"])
    return run


def score(docs: DataFrame, model: dict, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``score`` in (0, 1) for every row, from its whole text; null and empty texts get the base rate."""
    first, *rest = keep
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema.fields)
    return docs.select(F.col(first), F.col(text_col).alias("_text"), *rest).mapInArrow(_score(model), types + "score double")
