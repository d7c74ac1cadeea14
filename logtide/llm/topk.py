"""Exact top-k search by inner product with vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.session import written

SCALE = 256
CELL_BITS = 4
CHUNK_ROWS = 8192
QUERY_ROWS = 256
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of every component, one row per id.

    Left out: null ids, null vectors, and vectors with a null or non-finite component. Rows that repeat an id count as
    one, the smallest vector.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    kept = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & (F.size(v) > 0))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


class ApproximationFile:
    """Vectors of one length: cell numbers per dimension, cell borders, and the exact vectors beside them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bits: int = CELL_BITS):
        self.ids, self.vectors = ids, vectors
        edges = np.quantile(vectors, np.linspace(0, 1, (1 << bits) + 1), axis=0, method="lower")
        self.cells = np.stack([np.clip(np.searchsorted(edges[1:-1, d], vectors[:, d], side="right"), 0, (1 << bits) - 1)
                               for d in range(vectors.shape[1])], axis=1).astype(np.uint8)
        self.low, self.high = edges[:-1].astype(np.float64), edges[1:].astype(np.float64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner products that the cells allow, queries x vectors."""
        d = np.arange(self.cells.shape[1])
        low, high = self.low[self.cells, d], self.high[self.cells, d]
        plus, minus = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        slack = 1e-9 * (np.abs(queries).sum(axis=1) * max(1.0, np.abs(low).max(), np.abs(high).max()))[:, None]
        return plus @ low.T + minus @ high.T - slack, plus @ high.T + minus @ low.T + slack

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, at_once: int = 16) -> Iterator[tuple[int, int, int]]:
        """``(query, vector, score)`` of the k best of this file per query, its own id left out.

        Vectors that k lower bounds beat are out. The others are read in the order of their upper bounds, a few at a time,
        until the next upper bound is below the kth exact score.
        """
        lower, upper = self.bounds(queries)
        own = query_ids[:, None] == self.ids[None, :]
        lower[own] = upper[own] = -np.inf
        for i, q in enumerate(queries):
            up = upper[i]
            if len(up) > k:
                floor = np.partition(lower[i], len(up) - k)[len(up) - k]
                left = np.nonzero(up >= floor)[0]
            else:
                left = np.arange(len(up))
            left = left[np.isfinite(up[left])]
            left = left[np.argsort(-up[left], kind="stable")]
            scores = np.empty(0, np.int64)
            for lo in range(0, len(left), at_once):
                if lo >= k and up[left[lo]] < np.partition(scores, len(scores) - k)[len(scores) - k]:
                    break
                scores = np.append(scores, self.vectors[left[lo:lo + at_once]] @ q)
            read = left[:len(scores)]
            for j in np.lexsort((self.ids[read], -scores))[:k]:
                yield int(query_ids[i]), int(self.ids[read[j]]), int(scores[j])


def _search(k: int, bits: int):
    def matrix(blob: bytes, n: int) -> np.ndarray:
        return np.frombuffer(blob, "<i8").reshape(n, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            for chunk, is_query, ids, vectors in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.array(ids, np.int64)
                rows = matrix(vectors, len(ids))
                if not is_query:
                    file = (chunk, ApproximationFile(ids, rows, bits))
                elif file and file[0] == chunk:
                    found = list(file[1].search(ids, rows, k))
                    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])
    return run


def _blocks(rows: DataFrame, name: Column) -> DataFrame:
    """Rows of one block and length as one row: ids, and the vectors as little-endian 64-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.array(v, "<i8").tobytes() for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["block", "ids", "v"])
    grouped = rows.groupBy(name.alias("block"), F.size("v").alias("dim")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "v"))).alias("r"))
    flat = grouped.select(F.concat_ws("/", "block", "dim").alias("block"), F.col("r.vec_id").alias("ids"), F.flatten("r.v").alias("v"))
    return flat.mapInArrow(run, "block string, ids array<long>, v binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, bits: int = CELL_BITS, chunk_rows: int = CHUNK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` (over ``vec_id``) marks, its k best others.

    Score is the integer inner product of the quantised vectors; ties go to the smaller id; a query with fewer than k
    others gets them all. Vectors are compared with those of their own length only. See ``quantised`` for rows that take
    no part and repeated ids; a query among those has no result. Components must stay below 2^26 after scaling, or exact
    64-bit sums could overflow.

    The table is dealt into chunks of about ``chunk_rows`` rows, each a vector-approximation file in one task; blocks of
    ``query_rows`` queries pass through every chunk one after another. A chunk returns its k best per query, which hold
    the k best of all. Memory depends on the two sizes only, and no key of the data decides where a row goes.
    """
    rows = written(quantised(vectors, id_col, vector_col, scale), "quantised")
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    if not n or not n_queries:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    chunks, parts = max(1, -(-n // chunk_rows)), max(1, -(-n_queries // query_rows))
    deal = lambda m, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m))
    files = _blocks(rows, deal(chunks, 1)).select(F.col("block").alias("chunk"), F.lit(False).alias("is_query"), "ids", "v")
    asked = written(_blocks(rows.where(is_query), deal(parts, 2)), "queries")
    dims = written(files.select("chunk", F.split_part("chunk", F.lit("/"), F.lit(2)).alias("dim")).distinct(), "chunks")
    sent = asked.withColumn("dim", F.split_part("block", F.lit("/"), F.lit(2))).join(dims, "dim").select("chunk", F.lit(True).alias("is_query"), "ids", "v")
    met = files.union(sent).repartition(int(chunks), "chunk").sortWithinPartitions("chunk", "is_query")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.mapInArrow(_search(k, bits), FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
