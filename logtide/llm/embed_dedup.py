"""Near duplicates among embeddings by collision counting over one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtide.llm.common import connected_components
from logtide.session import written

PROJECTIONS = 64
WINDOW = 3.0
DENSE = 20  # projections counted for all pairs in reach; the others only for pairs that may still pass
SLAB = 128
RECALL = 0.99999
CHUNK_ROWS = 4096
LINKS = "vec_id long, n_links long, root long"


def directions(dim: int, count: int, seed: int = 5) -> np.ndarray:
    """Random unit directions (dim x count), orthogonal to each other within each ``dim`` of them."""
    rng, out = np.random.default_rng([seed, dim]), []
    while sum(x.shape[1] for x in out) < count:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(out, axis=1)[:, :count]


def allowed_misses(count: int, window: float, recall: float) -> int:
    """Most projections in which a pair at the similarity limit may fall outside the window.

    Along a random direction the two differ by a bell-shaped amount; ``window`` is in its standard deviations. Misses of
    ``count`` directions are then binomial, and the answer is the least number that they exceed with probability
    1 - ``recall`` at most. Closer pairs miss less.
    """
    miss = 1 - erf(window / sqrt(2))
    tail, most = 1.0, -1
    while tail > 1 - recall and most < count:
        most += 1
        tail -= comb(count, most) * miss**most * (1 - miss) ** (count - most)
    return most


class Projected:
    """Vectors of one length in the order of their first projection, with 8-bit projections for counting."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, similarity: float, count: int, window: float, recall: float):
        norms = np.sqrt((vectors * vectors).sum(axis=1))  # of finite components; squares that overflow link with nothing
        dim = vectors.shape[1]
        line = (vectors / norms[:, None]) @ directions(dim, count)
        order = np.argsort(line[:, 0], kind="stable")
        self.ids, self.vectors, self.norms, self.first = ids[order], vectors[order], norms[order], line[order, 0]
        self.half = window * sqrt(2 * (1 - similarity) / dim)  # of the query-centred window
        step = max(self.half / 24, 2.0 / 250)
        self.reach = int(np.ceil(self.half / step)) + 1  # rounding may only let pairs in
        self.codes = np.ascontiguousarray((np.clip(np.floor(line[order] / step), -125, 125) + 125).astype(np.uint8).T)
        self.misses, self.similarity = allowed_misses(count, window, recall), similarity
        self.gate = 2.0 * self.half  # the first projection's window is twice as wide: a miss there is as good as impossible


def linked(a: Projected, lo: int, hi: int, b: Projected) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into a, into b) of similar vectors, for queries ``lo`` to ``hi`` of a.

    The sorted first projection bounds the part of b that the windows reach. Collisions are counted over ``DENSE``
    projections for all pairs in it, over the rest for pairs that may still reach the count; those that do are verified.
    """
    left, right = np.searchsorted(b.first, [a.first[lo] - a.gate, a.first[hi - 1] + a.gate])
    if left >= right:
        return np.empty(0, int), np.empty(0, int)
    missed = np.zeros((hi - lo, right - left), np.uint8)
    gap, far = np.empty_like(missed), np.empty(missed.shape, bool)
    dense = min(DENSE, len(a.codes))
    for p in range(dense):
        np.subtract(a.codes[p, lo:hi, None] + np.uint8(a.reach), b.codes[p, None, left:right], out=gap)
        np.greater(gap, 2 * a.reach, out=far)
        missed += far
    i, j = np.nonzero(missed <= a.misses)
    count = missed[i, j].astype(np.int64)
    for p in range(dense, len(a.codes)):
        gap = (a.codes[p, lo + i] + np.uint8(a.reach)) - b.codes[p, left + j]
        count += gap > 2 * a.reach
        if p % 4 == 3:
            keep = count <= a.misses
            i, j, count = i[keep], j[keep], count[keep]
    keep = count <= a.misses
    i, j = lo + i[keep], left + j[keep]
    good = []
    for s in range(0, len(i), 1 << 16):
        u, v = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
        good.append((a.vectors[u] * b.vectors[v]).sum(axis=1) / (a.norms[u] * b.norms[v]) >= a.similarity)
    keep = np.concatenate(good) if good else np.empty(0, bool)
    return i[keep], j[keep]


class Forest:
    """Union-find over the ids of one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.setdefault(x, x)) != x:
            self.up[x] = self.up[y]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def join_all(self, x: np.ndarray, y: np.ndarray) -> None:
        """Joins pairs; only those that still connect two trees are looked at one by one."""
        while len(x):
            x, y = self._roots(x), self._roots(y)
            apart = x != y
            x, y = x[apart], y[apart]
            first = np.unique(y, return_index=True)[1]
            for u, v in zip(x[first].tolist(), y[first].tolist(), strict=True):
                self.join(u, v)

    def _roots(self, ids: np.ndarray) -> np.ndarray:
        unique, where = np.unique(ids, return_inverse=True)
        return np.array([self.root(x) for x in unique.tolist()], np.int64)[where]


def _meet(similarity: float, count: int, window: float, recall: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Projected, np.ndarray] | None = None
        for batch in batches:
            for chunk, order, ids, copies, blob in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                at = Projected(np.array(ids, np.int64), np.frombuffer(blob, "<f8").reshape(len(ids), -1), similarity, count, window, recall)
                weight = dict(zip(ids, copies, strict=True))
                weights = np.array([weight[x] for x in at.ids.tolist()], np.int64)
                if order < 0:
                    held = (chunk, at, weights)
                    continue
                if not held or held[0] != chunk:
                    continue
                _, own, own_weights = held
                same = order == 0
                forest, sums = Forest(), {}
                for lo in range(0, len(own.ids), SLAB):
                    i, j = linked(own, lo, min(lo + SLAB, len(own.ids)), at)
                    if same:
                        i, j = i[i != j], j[i != j]
                    for ids_, others, n in ((own.ids, weights[j], i),) if same else ((own.ids, weights[j], i), (at.ids, own_weights[i], j)):
                        for x, c in zip(*_sum(ids_[n], others), strict=True):
                            sums[x] = sums.get(x, 0) + c
                    forest.join_all(own.ids[i], at.ids[j])
                if sums:
                    found = list(sums)
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([sums[x] for x in found], pa.int64()),
                                                      pa.array([forest.root(x) for x in found], pa.int64())], names=["vec_id", "n_links", "root"])
    return run


def _sum(ids: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    unique, where = np.unique(ids, return_inverse=True)
    return unique.tolist(), np.bincount(where, values, len(unique)).astype(np.int64).tolist()


def near_duplicates(vectors: DataFrame, similarity: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors are projected on ``projections`` random directions. A pair collides in a direction if one lies in the other's
    window; pairs with enough collisions are verified by their cosine in double precision. The count is calibrated so that
    a pair at the limit passes with probability ``recall``.

    Equal vectors are one vector with a number of copies. The others are sorted by their first projection into chunks of
    ``chunk_rows``; a chunk meets itself and, one after another, those chunks after it that a window can reach. Link counts and
    local components leave a task, pairs never do, so a group of near copies of any size costs comparisons, not rows.

    Null, empty and zero vectors and those with null or non-finite components link with nothing: n_links 0, a component of
    their own, kept. Vectors of different lengths don't link. Rows that repeat an id are each a vector of their
    own, and links to them count each. Rows with a null id link with nothing and have null component and kept.
    """
    v = F.col(vector_col)
    wide = F.transform(v, lambda x: x.cast("double"))
    norm = F.aggregate(wide, F.lit(0.0), lambda s, x: s + x * x)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable & (norm > 0), wide).alias("v"))
    good = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    links = good.selectExpr("first vec_id", "0L n_links", "first root").limit(0)
    line = written(good.select("first", "copies", "v").mapInArrow(_first_line(projections), "first long, copies long, v array<double>, dim int, line double"), "line")
    if total := line.count():
        blocks = written(_sorted_blocks(line, max(1, -(-total // chunk_rows))), "blocks")
        gate = 2 * window * sqrt(2 * (1 - similarity)) / F.sqrt("x.dim") + 1e-9
        sides = written(blocks.select("block", "dim", "low", "high"), "sides")
        later = (F.col("y.dim") == F.col("x.dim")) & (F.col("y.low") > F.col("x.low")) & (F.col("y.low") <= F.col("x.high") + gate)
        meets = sides.alias("x").join(sides.alias("y"), later).select(F.col("x.block").alias("chunk"), F.col("y.block").alias("block"))
        meets = meets.union(sides.select(F.col("block").alias("chunk"), "block"))
        sent = blocks.join(meets, "block").select("chunk", F.when(F.col("chunk") == F.col("block"), 0).otherwise(1).alias("order"), "ids", "copies", "v")
        own = blocks.select(F.col("block").alias("chunk"), F.lit(-1).alias("order"), "ids", "copies", "v")
        met = own.union(sent).repartition(int(sides.count()), "chunk").sortWithinPartitions("chunk", "order")
        links = written(met.mapInArrow(_meet(similarity, projections, window, recall), LINKS), "links")
    counts = links.groupBy(F.col("vec_id").alias("_a")).agg(F.sum("n_links").alias("_links"))
    parts = connected_components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    known = line.select("first", "copies", F.col("v").alias("_v")).join(counts, F.col("first") == F.col("_a"), "left").join(parts, F.col("first") == F.col("node"), "left")
    named = F.col("vec_id").isNotNull()
    joined = rows.join(known, named & (F.col("v") == F.col("_v")), "left")
    component = F.when(named, F.coalesce("component", "first", "vec_id"))
    n = F.coalesce(F.col("_links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return joined.select("vec_id", n.cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _first_line(projections: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = [np.array(v) for v in batch.column(2).to_pylist()]
            for v in vectors:
                if len(v) not in known:
                    known[len(v)] = directions(len(v), projections)[:, 0]
            line = [float(v @ known[len(v)] / np.sqrt((v * v).sum())) for v in vectors]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(v) for v in vectors], pa.int32()), pa.array(line, pa.float64())],
                                             names=[*batch.schema.names, "dim", "line"])
    return run


def _sorted_blocks(line: DataFrame, chunks: int) -> DataFrame:
    """Chunks of neighbours along the first projection: cut at quantiles, so dense places are cut as finely as others."""
    cuts = line.groupBy("dim").agg(F.percentile_approx("line", [i / chunks for i in range(chunks)], 10_000).alias("cuts"))
    place = F.size(F.filter(F.array_distinct("cuts"), lambda c: c < F.col("line")))
    placed = line.join(written(cuts, "cuts"), "dim").select("dim", "line", "first", "copies", "v", F.concat_ws("/", "dim", place).alias("block"))
    rows = placed.groupBy("block").agg(F.first("dim").alias("dim"), F.min("line").alias("low"), F.max("line").alias("high"),
                                       F.collect_list(F.struct("first", "copies", "v")).alias("r"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.array(v, "<f8").tobytes() for v in batch.column(6).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(blobs, pa.binary())], names=[*batch.schema.names[:6], "v"])
    flat = rows.select("block", "dim", "low", "high", F.col("r.first").alias("ids"), F.col("r.copies").alias("copies"), F.flatten("r.v").alias("v"))
    return flat.mapInArrow(pack, "block string, dim int, low double, high double, ids array<long>, copies array<long>, v binary")
