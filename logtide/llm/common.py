"""What the operators share: byte-level words, column preparation, connected components over edges."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logtide.session import written
from logtide.sources.tables import table

CRC_FOLDS = 4
HELD_OUT_FOLD = 2
#: Seconds-free settings of the 64-bit mixers, fixed so that hashes agree between runs.
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BYTE_BASE = 0x9E3779B97F4A7C15


def documents(spark, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks, and what their allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves the held-out remainder; a null id counts as held out, so it never trains."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % CRC_FOLDS == HELD_OUT_FOLD, F.lit(True))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class WordHasher:
    """64-bit hashes of the white-space separated words of UTF-8 texts, A-Z in lower case.

    A word's hash is a polynomial over its bytes, taken from prefix sums of the whole
    text, so that no word becomes a Python object.
    """

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1 << 16)
            inverse = pow(BYTE_BASE, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.powers = np.cumprod(np.append(one, np.full(size - 1, BYTE_BASE, np.uint64)))
            self.inverse = np.cumprod(np.append(one, np.full(size - 1, inverse, np.uint64)))

    def words(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text.translate(_LOWER), np.uint8)
        if not len(raw):
            return np.empty(0, np.uint64)
        inside = np.ones(len(raw) + 2, np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))  # ~bool stays bool
        step = np.diff(inside)
        begin, end = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
        if not len(begin):
            return np.empty(0, np.uint64)
        self._grow(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[:len(raw)], out=sums[1:])
        return mix64((sums[end] - sums[begin]) * self.inverse[begin])


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(size, len(words))):
        out = mix64(out + np.uint64(j + 1)) + words[j:j + n]
    return np.unique(mix64(out))


#: Filter bits per code, and the most a filter may have (32 MB); beyond it, it only lets more pass.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 28


class BitFilter:
    """Which codes may be in a set: a bitmap over their low bits. Says yes for all that are."""

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = np.uint64(bits - 1), words

    def __contains__(self, code: int) -> bool:
        return bool(self.has(np.array([code], np.int64))[0])

    def has(self, codes: np.ndarray) -> np.ndarray:
        at = codes.view(np.uint64) & self.mask
        return (self.words[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_filter(codes: DataFrame, n: int) -> BitFilter:
    """The filter of ``code``, built from partial bitmaps in Spark; the driver receives its bytes and no code."""
    bits = 1 << 18
    while bits < min(n * FILTER_BITS, MOST_FILTER_BITS):
        bits <<= 1
    at = F.col("code").bitwiseAND(F.lit(bits - 1)) + 1
    rows = codes.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("b")).collect()
    words = np.zeros(bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r.b), np.uint8)
        low = (r.bucket - 1) * len(part)
        words[low:low + len(part)] = part
    return BitFilter(bits, words)


#: A graph of so many edges, 16 MB, is solved by one task.
LOCAL_EDGES = 1 << 20


def label_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node reachable from each: roots hook onto smaller neighbours, paths are halved."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, label[a], least)
        np.minimum.at(now, label[b], least)
        while (now[now] != now).any():
            now = now[now]
        if (now == label).all():
            return nodes, nodes[label]
        label = now


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [[b.column(i).to_numpy() for i in (0, 1)] for b in batches if b.num_rows]
    if parts:
        nodes, labels = label_nodes(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], names=["node", "component"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge that is not a loop.

    Alternates two steps until nothing changes: every neighbour above a node links to the
    smallest node around it, then every node links its smaller neighbours to the smallest.
    Stars of any size stay linear: minima combine in each task before the shuffle. Each
    round ends in a written table. A graph of at most ``local_edges`` edges needs no rounds:
    one task holds all of it.
    """
    least, most = F.least(a, b).cast("long").alias("v"), F.greatest(a, b).cast("long").alias("u")
    at = written(edges.select(most, least).where("u <> v"), "edges")
    if at.count() <= local_edges:
        return written(at.coalesce(1).mapInArrow(_label, "node long, component long"), "components")
    at = written(at.distinct(), "edges")
    state = _signature(at)
    for _ in range(rounds):
        if not state[0]:
            break
        both = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        at = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _signature(at)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    members = at.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
