"""N-gram Jaccard join by T-occurrence search: short inverted lists are merged, long ones probed (DivideSkip)."""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logtide.llm.common import WordHasher, bit_filter, connected_components, give_back, mix64, shingle_set
from logtide.operators.ordered import dense_positions
from logtide.session import written

SIZE = 5
PERCENT = 80
BUCKET_SHINGLES = 2_000_000
#: Shingles that a task holds before it sends them on.
FLUSH_SHINGLES = 500_000
RANGE_DOCS = 100_000
SALTS = 32
BLOCK = 512
MU = 0.0085  # cost of a probe against a merge step, from the DivideSkip paper
MULTI = np.uint32(0xFFFFFFFF)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("text"))


def _key(s: np.ndarray) -> int:
    return int(s.sum(dtype=np.uint64).astype(np.int64))


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            counts, one, two = [], [], []
            for text in batch.column(1):
                s = shingle_set(hasher.words(text.as_py()), size)
                counts.append(len(s))
                one.append(_key(s))
                two.append(_key(mix64(s ^ np.uint64(0x5851F42D4C957F2D))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             names=["doc_id", "n", "k1", "k2"])
    return run


def _postings(size: int, buckets: int):
    """Per bucket of the hash space, the shingles of a run of documents and which document has them.

    Equal texts of a run count as their first. A shingle of several documents of the run is sent once, marked as shared,
    and counted for them here: a shingle that very many documents hold costs one entry per run, not one per document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, ids, sets, total, turn = WordHasher(), set(), [], [], 0, 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = text.as_py()
                if raw in seen or doc is None:
                    continue
                s = shingle_set(hasher.words(raw), size)
                if not len(s):
                    continue
                seen.add(raw)
                ids.append(doc), sets.append(s)
                total += len(s)
                if total >= FLUSH_SHINGLES:
                    yield _flush(ids, sets, buckets, turn)
                    seen, ids, sets, total, turn = set(), [], [], 0, turn + 1
        if ids:
            yield _flush(ids, sets, buckets, turn)
    return run


def _flush(ids: list[int], sets: list[np.ndarray], buckets: int, turn: int) -> pa.RecordBatch:
    hashes = np.concatenate(sets)
    who = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(s) for s in sets])
    order = np.argsort(hashes, kind="stable")
    hashes, who = hashes[order], who[order]
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    runs = np.diff(np.append(np.nonzero(first)[0], len(hashes)))
    shared = np.repeat(runs > 1, runs)
    counts = np.bincount(who[shared], minlength=len(ids))
    who[shared] = MULTI
    hashes, who = hashes[first], who[first]
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # hashes are sorted, so buckets are slices
    at = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    low = (mix64(hashes) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    docs, none, home = np.array(ids, np.int64), np.zeros(0, np.int64), turn % buckets
    rows = []
    for b in np.union1d(bucket, [home]).astype(np.int64).tolist():  # buckets without a shingle of this run get no row
        own = who[at[b]:at[b + 1]]
        used = np.unique(own[own != MULTI])
        kind = np.uint16 if len(used) < 0xFFFF else np.uint32
        local = np.searchsorted(used, own).astype(kind)
        local[own == MULTI] = np.iinfo(kind).max
        counted = (docs, counts.astype(np.int64)) if b == home else (none, none)
        rows.append((b, low[at[b]:at[b + 1]].tobytes(), local.tobytes(), docs[used].tobytes(), *[c.tobytes() for c in counted]))
    names = ["bucket", "hashes", "who", "ids", "counted", "counts"]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 6)]], names=names)


def _by_key(handle, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``handle`` on the rows of each value of the first column, by which they come sorted."""
    held: list[tuple] = []
    at = None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if at is not None and row[0] != at:
                yield handle(held)
                held = []
            at = row[0]
            held.append(row[1:])
    if held:
        yield handle(held)


def _shared(ranges: int):
    """Over one bucket: how many shingles each document shares with any other, as one row per range of documents."""
    def pack(rows: list[tuple]) -> pa.RecordBatch:
        ids, counts = _count(rows)
        place = (mix64(ids.astype(np.uint64)) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, ids, counts = place[order], ids[order], counts[order]
        found, start = np.unique(place, return_index=True)
        cut = lambda x: [p.tobytes() for p in np.split(x, start[1:])] if len(found) else []
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(cut(ids), pa.binary()), pa.array(cut(counts), pa.binary())],
                                          names=["range", "ids", "counts"])
    return lambda batches: _by_key(pack, batches)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one range of documents from all buckets, summed."""
    def add(rows: list[tuple]) -> pa.RecordBatch:
        ids, counts = (np.frombuffer(b"".join(r[i] for r in rows), np.int64) for i in (0, 1))
        unique, where = np.unique(ids, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(unique), pa.array(np.bincount(where, counts, len(unique)).astype(np.int64))], names=["doc_id", "shared"])
    return _by_key(add, batches)


def _count(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    low = np.concatenate([np.frombuffer(r[0], np.uint32) for r in rows])
    ids = np.concatenate([np.frombuffer(r[2], np.int64) for r in rows])
    who, base = [], 0
    for r in rows:
        kind = np.uint16 if len(r[1]) < len(r[0]) else np.uint32
        w = np.frombuffer(r[1], kind).astype(np.int64)
        w[w == np.iinfo(kind).max] = -1
        who.append(np.where(w < 0, -1, w + base))
        base += len(r[2]) // 8
    who = np.concatenate(who)
    order = np.argsort(low, kind="stable")
    low, who = low[order], who[order]
    first = np.concatenate([[True], low[1:] != low[:-1]]) if len(low) else np.zeros(0, bool)
    runs = np.diff(np.append(np.nonzero(first)[0], len(low)))
    more = np.repeat(runs > 1, runs) & (who >= 0)
    counts = np.bincount(who[more], minlength=len(ids))
    docs = np.concatenate([ids, *[np.frombuffer(r[3], np.int64) for r in rows]])
    counts = np.concatenate([counts, *[np.frombuffer(r[4], np.int64) for r in rows]])
    unique, where = np.unique(docs[counts > 0], return_inverse=True)
    return unique, np.bincount(where, counts[counts > 0], len(unique)).astype(np.int64)


def _shingles(size: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            held, total = [], 0
            for i in np.nonzero(named & wanted.value.has(ids))[0]:
                s = shingle_set(hasher.words(batch.column(1)[int(i)].as_py()), size)
                held.append((ids[i], _key(s), s.tobytes()))
                total += len(s)
                if total >= FLUSH_SHINGLES:
                    yield _rows(held)
                    held, total = [], 0
            yield _rows(held)
            give_back()
    return run


def _rows(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                                       pa.array([h[2] for h in held], pa.binary())], names=["doc_id", "k1", "s"])


def least_overlap(n: int | np.ndarray, m: int | np.ndarray, percent: int = PERCENT):
    """Fewest common elements of sets of n and m elements with 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each entry of the inverted lists."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            blobs = part.column(2).to_pylist()
            sizes = [len(b) // 8 for b in blobs]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(i).to_numpy(), sizes)) for i in (0, 1)]
                                             + [pa.array(np.frombuffer(b"".join(blobs), np.int64))], names=["doc_id", "n", "token"])


class InvertedLists:
    """Lists of the local documents that hold each shingle, in the order of the documents."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        self.tokens, self.start = np.unique(tokens, return_index=True)
        self.stop = np.append(self.start[1:], len(tokens))

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Documents whose overlap with ``query`` makes them linked.

        T is the least overlap with any linked document. The L longest lists, L as DivideSkip chooses it, are left out of
        the merge: documents need T - L occurrences in the short lists, and only those are looked for in the long ones, by
        binary search, until each has or misses the overlap that its own size asks for.
        """
        if not len(self.tokens):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        need = int(-(-percent * len(query) // 100))
        if len(at) < need:
            return np.zeros(0, np.int64)
        lengths = self.stop[at] - self.start[at]
        at = at[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        n_long = max(0, min(need - 1, int(need / (MU * log2(max(longest, 2)) + 1))))
        short, long_ = at[:len(at) - n_long], at[len(at) - n_long:]
        merged = np.concatenate([self.owner[self.start[t]:self.stop[t]] for t in short])
        counts = np.bincount(merged, minlength=len(self.sizes))
        wanted = np.maximum(need, least_overlap(len(query), self.sizes, percent))
        found = np.nonzero((counts > 0) & (counts >= need - n_long) & (counts + n_long >= wanted))[0]
        have = counts[found]
        for k, t in enumerate(long_):
            if not len(found):
                break
            row = self.owner[self.start[t]:self.stop[t]]
            hit = np.minimum(np.searchsorted(row, found), len(row) - 1)
            have = have + (row[hit] == found)
            if k % 16 == 15:
                keep = have + (n_long - k - 1) >= wanted[found]
                found, have = found[keep], have[keep]
        return found[have >= wanted[found]]


def block_links(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]] | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs of (id, component, set) connect, beyond the components given.

    ``right`` None: pairs within ``left``. A document's search is skipped if all that it could meet is in its component.
    """
    index = left if right is None else right
    lists = InvertedLists([s for *_, s in index])
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x
    groups = {c for _, c, _ in index}
    out = []
    for doc, component, s in left:
        if groups == {component}:
            continue
        for hit in lists.search(s, percent):
            other, c, _ = index[hit]
            a, b = root(component), root(c)
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((doc, other))
    return out


def _links(percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("side").to_pylist(), table.column("doc_id").to_pylist(), table.column("component").to_pylist(),
                        (np.frombuffer(b, np.uint64) for b in table.column("s").to_pylist()), strict=True))
        left = [r[1:] for r in rows if r[0] == 0]
        right = [r[1:] for r in rows if r[0] == 1]
        found = block_links(left, right or None, percent)
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def _search(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within the blocks of ``placed`` (block, side, doc_id, component)."""
    return placed.join(sets.select("doc_id", "s"), "doc_id").groupBy("block").applyInArrow(_links(percent), "a long, b long")


def component_ids(docs: DataFrame, percent: int = PERCENT, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the smallest id reachable by links of Jaccard ``percent`` or more.

    1. Every text becomes the set of hashes of its ``size``-word runs (A-Z in lower case); rows with equal sets are one.
    2. Shingles are counted over all documents. A document can only be linked if ``percent`` of its shingles occur in
       others too; the rest is done with. Nothing is sampled: this is a necessary condition.
    3. The documents left are gathered with those that they share a prefix shingle with, the only ones they can link to.
       Gathered groups are closed under such sharing, so no pair is met twice.
    4. In each group, T-occurrence search over its inverted lists finds the links. Groups of more than ``block`` documents are
       cut: first blocks of similar size, then representatives of the components so far, at last all pairs of blocks
       that are not known to be one component. So a family of any size is spread over tasks, and no pair is emitted.

    Null and empty texts and texts without words have no shingles and link with nothing; shorter texts than ``size`` words
    are one shingle. Rows that repeat an id are joined through it. Rows with a null id link with nothing, and their
    component is null. Hashes have 64 bits.
    """
    texts = _texts(docs, id_col, text_col)
    signed = written(texts.mapInArrow(_signatures(size), "doc_id long, n long, k1 long, k2 long"), "signatures")
    rows, total = signed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = int(max(tasks, -(-total // BUCKET_SHINGLES)))
    posted = texts.mapInArrow(_postings(size, buckets), "bucket int, hashes binary, who binary, ids binary, counted binary, counts binary")
    ranges = max(2 * tasks, -(-rows // RANGE_DOCS))
    counted = posted.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared(ranges), "range long, ids binary, counts binary")
    shared = counted.repartition("range").sortWithinPartitions("range").mapInArrow(_sums, "doc_id long, shared long")
    named = signed.where("n > 0 AND doc_id IS NOT NULL")
    known = named.join(shared, "doc_id", "left").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.max("shared").alias("shared"))
    reps = written(known, "sets")
    sets = reps.where(f"shared * 100 >= n * {percent}")
    wanted = docs.sparkSession.sparkContext.broadcast(bit_filter(sets.select(F.col("doc_id").alias("code")), sets.count()))
    fetched = texts.mapInArrow(_shingles(size, wanted), "doc_id long, k1 long, s binary")
    left = written(sets.join(fetched, ["doc_id", "k1"]).dropDuplicates(["doc_id", "k1", "k2"]).select("doc_id", "n", "s"), "linkable")
    links = _find_links(left, percent, block)
    parts = connected_components(links)
    whole = reps.join(parts, F.col("doc_id") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "doc_id").alias("component_id"))
    linked = named.join(whole, ["k1", "k2"])
    repeated = linked.groupBy("doc_id").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y")).where("x <> y")
    if not repeated.isEmpty():  # an id on several texts joins their components
        more = linked.join(repeated.select("doc_id", "x"), "doc_id").select(F.col("component_id").alias("a"), F.col("x").alias("b"))
        again = connected_components(more).withColumnRenamed("component", "_c")
        linked = linked.join(again, F.col("component_id") == F.col("node"), "left").withColumn("component_id", F.coalesce("_c", "component_id"))
    rest = signed.where("n = 0 OR doc_id IS NULL")
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(rest.select("doc_id", F.col("n"), F.col("doc_id")))


def _find_links(left: DataFrame, percent: int, block: int) -> DataFrame:
    lists = left.select("doc_id", "n", "s").mapInArrow(_lists, "doc_id long, n long, token long")
    lengths = lists.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    doc = Window.partitionBy("doc_id", "n")
    ranked = lists.join(lengths, "token").select(
        "doc_id", "token", F.row_number().over(doc.orderBy("df", "token")).alias("at"), F.count("*").over(doc).alias("shared"), F.ceil(F.col("n") * percent / 100).alias("need"))
    # Of the shingles that others share, rarest first, all but the least overlap: linked documents share one of these.
    prefixes = written(ranked.where("at <= shared - need + 1").select("doc_id", "token"), "prefixes")
    hub = prefixes.groupBy("token").agg(F.min("doc_id").alias("hub"), F.count("*").alias("c")).where("c > 1").select("token", "hub")
    near = prefixes.join(hub, "token").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).where("a <> b").distinct()
    groups = connected_components(near).select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    # Only groups beyond a block are named, salted: the members of one meet their flag in many tasks.
    over = groups.groupBy("grp").agg(F.count("*").alias("members")).where(F.col("members") > block)
    over = over.select("grp", F.lit(True).alias("large"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    ids = left.select("doc_id", "n", F.col("doc_id").alias("component"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    placed = written(ids.join(groups, "doc_id").join(over, ["grp", "salt"], "left").drop("salt"), "grouped")
    small = placed.where("large IS NULL").select(F.concat_ws("/", F.lit("g"), "grp").alias("block"), F.lit(0).alias("side"), "doc_id", "component")
    links = written(_search(small, left, percent), "links")
    large = placed.where("large").drop("large")
    if large.isEmpty():
        return links
    sets = written(left.join(large.select("doc_id").distinct(), "doc_id"), "large")
    return links.union(_large_groups(large, sets, percent, block))


def _cut(rows: DataFrame, block: int, *order: str) -> DataFrame:
    """``rows`` with a number of their block: about ``block`` rows each, in the order given, ties and all.

    Numbered through a sort over the cluster, so no group's rows meet in one task.
    """
    numbered = dense_positions(rows.select("grp", "doc_id", *[c for c in order if c not in ("grp", "doc_id")]), ["grp"], [*order, "doc_id"], "at")
    return rows.join(numbered.select("doc_id", F.floor(F.col("at") / block).alias("part")), "doc_id")


def _large_groups(large: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    def relabel(links: DataFrame) -> DataFrame:
        parts = connected_components(links).withColumnRenamed("component", "_c")
        named = large.drop("component").join(parts, F.col("doc_id") == F.col("node"), "left")
        return named.select("grp", "doc_id", "n", F.coalesce("_c", "doc_id").alias("component"))

    def within(rows: DataFrame) -> DataFrame:
        return _search(rows.select(F.concat_ws("/", "grp", "part").alias("block"), F.lit(0).alias("side"), "doc_id", "component"), sets, percent)
    links = written(within(_cut(large, block, "n")), "links")
    rows = written(relabel(links), "labelled")
    # A few members of every component, mixed: most of a family becomes one component here.
    links = written(links.union(within(_cut(rows.join(_heads(rows), "doc_id"), block, "h"))), "links")
    rows = written(_cut(relabel(links), block, "component", "n"), "labelled")
    parts = written(rows.groupBy("grp", "part").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most")), "parts")
    x, y = parts.alias("x"), parts.alias("y")
    meets = x.join(y, (F.col("x.grp") == F.col("y.grp")) & (F.col("x.part") < F.col("y.part"))
                   & ~((F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low")))
                   & (F.col("x.most") * 100 >= F.col("y.least") * percent) & (F.col("y.most") * 100 >= F.col("x.least") * percent))
    pairs = meets.select("x.grp", F.col("x.part").alias("p"), F.col("y.part").alias("q"))
    sides = pairs.select("grp", "p", "q", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("part")), F.struct(F.lit(1).alias("side"), F.col("q").alias("part")))).alias("e"))
    crossed = rows.join(sides.select("grp", "p", "q", "e.side", "e.part"), ["grp", "part"])
    last = _search(crossed.select(F.concat_ws("/", "grp", "p", "q").alias("block"), "side", "doc_id", "component"), sets, percent)
    return links.union(written(last.union(within(rows)), "links"))


def _heads(rows: DataFrame) -> DataFrame:
    """Per component the members with the smallest hashes, in 16 hash ranges: minima combine before the shuffle."""
    h = F.xxhash64("doc_id")
    best = rows.groupBy("grp", "component", F.pmod(h, F.lit(16)).alias("r")).agg(F.min(F.struct(h.alias("h"), "doc_id")).alias("m"))
    return best.select("m.doc_id", "m.h")
