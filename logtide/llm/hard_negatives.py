"""Hard-negative mining over Hilbert-ordered blocks of vectors with zone maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.operators.ordered import dense_positions
from logtide.session import written

SCALE = 256
#: The curve runs through this many dimensions, those that vary most, with so many bits each.
CURVE_DIMS, CURVE_BITS = 8, 4
#: Vectors in a block, blocks that one task reads, zone maps in a page, anchors in a group.
BLOCK_ROWS, READER_BLOCKS, PAGE_BLOCKS, ANCHOR_ROWS = 512, 16, 64, 256
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1


def eligible(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """``vec_id, label, anchor, v, dim``: rows with an id, a label and a finite vector, components as floor(scale * x).

    Rows that repeat an id count as one: the smallest by label, then vector.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    kept = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & finite & (F.size(v) > 0))
    row = F.struct(F.col(label_col).cast("long").alias("label"), whole.alias("v"))
    one = kept.select(F.col(id_col).cast("long").alias("vec_id"), row.alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.label", F.coalesce(is_anchor, F.lit(False)).alias("anchor"), "row.v", F.size("row.v").alias("dim"))


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers on the Hilbert curve through a cube of 2^bits cells a side."""
    x = cells.T.astype(np.uint64).copy()
    d, one = len(x), np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(d):
            turned = (x[i] & np.uint64(q)) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[d - 1] & np.uint64(q)) != 0, flip ^ np.uint64(q - 1), flip)
        q >>= 1
    x ^= flip
    index = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            index = (index << one) | ((x[i] >> np.uint64(b)) & one)
    return index.astype(np.int64)


def _rows(column: pa.Array, i: int) -> np.ndarray:
    """The list in row ``i`` of an Arrow list column."""
    at = column.offsets[i].as_py(), column.offsets[i + 1].as_py()
    return column.values[at[0]:at[1]].to_numpy(zero_copy_only=False)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per vector length: rows, sums and sums of squares of each component."""
    for batch in batches:
        by_length: dict[int, list] = {}
        for i in range(batch.num_rows):
            v = _rows(batch.column(0), i).astype(np.float64)
            by_length.setdefault(len(v), []).append(v)
        for dim, vs in by_length.items():
            m = np.stack(vs)
            yield pa.RecordBatch.from_pylist([{"dim": dim, "n": len(m), "at": j, "s": s, "q": q} for j, (s, q) in
                                              enumerate(zip(m.sum(0).tolist(), (m * m).sum(0).tolist(), strict=True))])


def curve(rows: DataFrame, dims: int = CURVE_DIMS, bits: int = CURVE_BITS) -> dict[int, tuple]:
    """Vector length to (dimensions of the curve, their means, their deviations): a few numbers for each length there is."""
    sums = rows.select("v").mapInArrow(_spread, "dim long, n long, at long, s double, q double")
    moments = sums.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean = F.col("s") / F.col("n")
    moments = moments.select("dim", "at", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean)).alias("sd"))
    best = Window.partitionBy("dim").orderBy(F.desc("sd"), "at")
    picked = moments.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= dims)
    found: dict[int, list] = {}
    for r in sorted(picked.collect(), key=lambda r: (r.dim, r.rank)):
        found.setdefault(r.dim, []).append((r["at"], r["mean"], r["sd"]))
    return {d: tuple(np.array(x) for x in zip(*at, strict=True)) for d, at in found.items()}


def _on_curve(curves: dict[int, tuple], bits: int):
    """Adds ``h``: components in equal steps of deviations around the mean, then the curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.zeros(batch.num_rows, np.int64)
            lengths = batch.column(batch.schema.get_field_index("dim")).to_numpy()
            v = batch.column(batch.schema.get_field_index("v"))
            for dim in np.unique(lengths):
                at = np.nonzero(lengths == dim)[0]
                axes, mean, sd = curves[int(dim)]
                m = np.stack([_rows(v, i)[axes] for i in at]).astype(np.float64)
                z = np.divide(m - mean, sd, out=np.zeros_like(m), where=sd > 0)
                h[at] = hilbert_index(np.clip(np.floor((z + 2) / 4 * (1 << bits)), 0, (1 << bits) - 1), bits)
            yield batch.append_column("h", pa.array(h))
    return run


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T; those beyond 64 bits end at the largest or smallest number."""
    limit = int(max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0))))) * int(max(abs(int(b.max(initial=0))), abs(int(b.min(initial=0))))) * a.shape[1]
    if limit < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if limit < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


def interval_products(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each vector with any vector between ``low`` and ``high``, per box."""
    sign = np.concatenate([np.maximum(a, 0), np.minimum(a, 0)], axis=1)
    return products(sign, np.concatenate([low, high], axis=1)), products(sign, np.concatenate([high, low], axis=1))


BLOCK = "dim int, block long, ids array<long>, labels array<long>, anchors array<boolean>, v array<long>, low array<long>, high array<long>, label_low long, label_high long"


def _zoned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"low": [], "high": [], "label_low": [], "label_high": []}
        for i in range(batch.num_rows):
            ids, labels = _rows(batch.column(2), i), _rows(batch.column(3), i)
            m = _rows(batch.column(5), i).reshape(len(ids), -1)
            for name, x in (("low", m.min(0)), ("high", m.max(0)), ("label_low", labels.min()), ("label_high", labels.max())):
                out[name].append(x)
        types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))],
                                         names=["dim", "block", "ids", "labels", "anchors", "v", *out])


def blocks_of(placed: DataFrame, block_rows: int) -> DataFrame:
    """One row per block: its vectors in order, least and greatest value of every dimension, least and greatest label."""
    row = F.struct("position", "vec_id", "label", "anchor", "v")
    grouped = placed.groupBy("dim", F.floor(F.col("position") / block_rows).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("r"))
    flat = grouped.select("dim", "block", F.col("r.vec_id").alias("ids"), F.col("r.label").alias("labels"), F.col("r.anchor").alias("anchors"),
                          F.flatten("r.v").alias("v"))
    return flat.mapInArrow(_zoned, BLOCK)


def _home_floor(k: int):
    """For each anchor the kth best score among rows of its label in its own block, if there are so many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels, own = (_rows(batch.column(j), i) for j in range(3))
                m = _rows(batch.column(3), i).reshape(len(ids), -1)
                at = np.nonzero(own)[0]
                scores = products(m[at], m)
                scores[labels[at][:, None] != labels[None, :]] = LEAST
                scores[np.arange(len(at)), at] = LEAST
                floor = np.partition(scores, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(at), LEAST)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(floor)], names=["vec_id", "floor"])
    return run


GROUP_COLUMNS = ("ids", "labels", "v", "lows", "highs")


def _grouped(anchors: DataFrame) -> DataFrame:
    """Anchors ``vec_id, label, v, lows, highs, dim, grp`` as one row per group; lows and highs are their windows of scores."""
    r = F.sort_array(F.collect_list(F.struct("vec_id", "label", "v", "lows", "highs")))
    grouped = anchors.groupBy("dim", "grp").agg(r.alias("r"))
    return grouped.select("dim", "grp", F.col("r.vec_id").alias("ids"), F.col("r.label").alias("labels"), F.flatten("r.v").alias("v"),
                          F.flatten("r.lows").alias("lows"), F.flatten("r.highs").alias("highs"))


def _group(batch: pa.RecordBatch, i: int):
    ids, labels, v, lows, highs = (_rows(batch.column(batch.schema.get_field_index(c)), i) for c in GROUP_COLUMNS)
    return ids, labels, v.reshape(len(ids), -1), lows.reshape(len(ids), -1), highs.reshape(len(ids), -1)


def _touches(least, greatest, lows, highs) -> np.ndarray:
    """Whether the interval of an anchor's scores in a block meets one of the anchor's windows, anchors x blocks."""
    out = np.zeros(least.shape, bool)
    for j in range(lows.shape[1]):
        out |= (greatest >= lows[:, j, None]) & (least <= highs[:, j, None]) & (lows[:, j] <= highs[:, j])[:, None]
    return out


def _choose(same_label: bool):
    """Blocks that an anchor must read, from a page of zone maps and the groups of anchors that come after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = None
        for batch in batches:
            col = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            for i in range(batch.num_rows):
                key = col("key")[i].as_py()
                if not col("is_group")[i].as_py():
                    block = _rows(col("block_nos"), i)
                    low, high = (_rows(col(c), i).reshape(len(block), -1) for c in ("low", "high"))
                    page = (key, block, low, high, _rows(col("label_lows"), i), _rows(col("label_highs"), i))
                elif page and page[0] == key:
                    _, block, low, high, label_low, label_high = page
                    _, labels, v, lows, highs = _group(batch, i)
                    labels = labels[:, None]
                    fits = (label_low <= labels) & (labels <= label_high) if same_label else (label_low != labels) | (label_high != labels)
                    ok = _touches(*interval_products(v, low, high), lows, highs) & fits
                    hit = np.nonzero(ok.any(axis=0))[0]
                    yield pa.RecordBatch.from_arrays([pa.array([v.shape[1]] * len(hit), pa.int32()), pa.array([col("grp")[i].as_py()] * len(hit), pa.int64()),
                                                      pa.array(block[hit]), pa.array([np.nonzero(ok[:, h])[0].astype(np.int32) for h in hit], pa.list_(pa.int32()))],
                                                     names=["dim", "grp", "block", "which"])
    return run


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best of each anchor and window: scores descending, ties by smaller id."""
    anchor, window, vec, score = found
    order = np.lexsort((vec, -score, window, anchor))
    anchor, window, vec, score = (x[order] for x in found)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])) if len(anchor) else np.empty(0, bool)
    start = np.nonzero(new)[0]
    rank = np.arange(len(anchor)) - np.repeat(start, np.diff(np.append(start, len(anchor))))
    return [x[rank < k] for x in (anchor, window, vec, score)]


FOUND = "anchor_id long, slot int, vec_id long, score long"


def _read(same_label: bool, k: int):
    """Exact scores from the chosen blocks: greatest upper bound first; an anchor skips a block that cannot improve a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for batch in batches:
            col = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            for i in range(batch.num_rows):
                if key != col("key")[i].as_py():
                    key, held = col("key")[i].as_py(), {}
                if not col("is_group")[i].as_py():
                    ids = _rows(col("ids"), i)
                    held[col("block")[i].as_py()] = (ids, _rows(col("labels"), i), _rows(col("v"), i).reshape(len(ids), -1), _rows(col("low"), i), _rows(col("high"), i))
                    continue
                ids, labels, v, lows, highs = _group(batch, i)
                asked = [(held[r["block"]], np.array(r["which"])) for r in col("asked")[i].as_py()]
                bounds = [interval_products(v[which], b[3][None], b[4][None]) for b, which in asked]
                floor = lows.copy()
                found = [np.empty(0, np.int64)] * 4
                for n in sorted(range(len(asked)), key=lambda n: -int(bounds[n][1].max())):
                    (vec, block_labels, m, _, _), which = asked[n]
                    useful = _touches(*bounds[n], floor[which], highs[which])[:, 0]
                    which = which[useful]
                    if not len(which):
                        continue
                    scores = products(v[which], m)
                    same = labels[which][:, None] == block_labels[None, :]
                    fits = (same if same_label else ~same) & (ids[which][:, None] != vec[None, :])
                    for j in range(lows.shape[1]):
                        a, c = np.nonzero(fits & (scores >= floor[which, j][:, None]) & (scores <= highs[which, j][:, None]))
                        found = [np.concatenate(x) for x in zip(found, (which[a], np.full(len(a), j), vec[c], scores[a, c]), strict=True)]
                    found = _best(found, k)
                    cell = found[0] * lows.shape[1] + found[1]
                    full, first, n_found = np.unique(cell, return_index=True, return_counts=True)
                    full, first = full[n_found == k], first[n_found == k]
                    floor.reshape(-1)[full] = found[3][first + k - 1]
                yield pa.RecordBatch.from_arrays([pa.array(ids[found[0]]), pa.array(found[1].astype(np.int32)), pa.array(found[2]), pa.array(found[3])],
                                                 names=["anchor_id", "slot", "vec_id", "score"])
    return run


def search_windows(blocks: DataFrame, anchors: DataFrame, same_label: bool, k: int, pages: dict[int, int],
                   reader_blocks: int = READER_BLOCKS, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: for each anchor and window the k best rows whose score is inside, and maybe more.

    First pages of zone maps meet the groups of anchors and give the blocks that each must read; only these blocks, and for
    each only the groups that ask for it, then meet again and are scored.
    """
    groups = written(_grouped(anchors), "anchor-groups")
    zone = F.sort_array(F.collect_list(F.struct("block", "low", "high", "label_low", "label_high")))
    paged = blocks.groupBy("dim", F.floor(F.col("block") / page_blocks).alias("page")).agg(zone.alias("z"))
    zones = paged.select(F.concat_ws("/", "dim", "page").alias("key"), F.lit(False).alias("is_group"), F.col("z.block").alias("block_nos"), F.flatten("z.low").alias("low"),
                         F.flatten("z.high").alias("high"), F.col("z.label_low").alias("label_lows"), F.col("z.label_high").alias("label_highs"))
    n_pages = F.create_map(*[F.lit(x) for dim, n in pages.items() for x in (dim, n)])
    sent = groups.withColumn("page", F.explode(F.sequence(F.lit(0), n_pages[F.col("dim")] - 1)))
    sent = sent.select(F.concat_ws("/", "dim", "page").alias("key"), F.lit(True).alias("is_group"), "grp", *GROUP_COLUMNS)
    met = zones.unionByName(sent, allowMissingColumns=True).repartition(sum(pages.values()), "key").sortWithinPartitions("key", "is_group")
    asked = written(met.mapInArrow(_choose(same_label), "dim int, grp long, block long, which array<int>"), "asked")
    reader = F.floor(F.col("block") / reader_blocks)
    wanted = blocks.join(asked.select("dim", "block").distinct(), ["dim", "block"], "left_semi")
    files = wanted.select(F.concat_ws("/", "dim", reader).alias("key"), F.lit(False).alias("is_group"), "block", "ids", "labels", "v", "low", "high")
    orders = asked.groupBy("dim", "grp", reader.alias("reader")).agg(F.sort_array(F.collect_list(F.struct("block", "which"))).alias("asked"))
    sent = orders.join(groups, ["dim", "grp"]).select(F.concat_ws("/", "dim", "reader").alias("key"), F.lit(True).alias("is_group"), "grp", "asked", *GROUP_COLUMNS)
    met = files.unionByName(sent, allowMissingColumns=True)
    readers = sum(-(-n * page_blocks // reader_blocks) for n in pages.values())
    return met.repartition(readers, "key").sortWithinPartitions("key", "is_group").mapInArrow(_read(same_label, k), FOUND)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS,
         anchor_rows: int = ANCHOR_ROWS, reader_blocks: int = READER_BLOCKS, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows that ``is_anchor`` (over ``vec_id``) marks. An anchor's positives are its best other rows of its label
    by integer inner product, ties by smaller id; for each, the best rows of other labels follow whose score lies between
    ``least_percent`` and ``most_percent`` percent of the positive's. A negative positive score has no such rows.

    Rows without id, label or finite vector take no part, and rows that repeat an id count as one (see ``eligible``).
    Vectors meet those of their own length only. Components and scores that pass 64 bits end at the largest number. An
    empty table, or one without anchors, gives no rows; further columns of any name are not read.

    Rows are ordered by label and Hilbert curve and cut into Parquet blocks of ``block_rows`` with least and greatest value of
    every dimension. Interval arithmetic gives a block's least and greatest score for an anchor: an anchor reads only blocks
    that may beat the kth best positive of its own block, and then those that meet a window. Memory depends on the sizes
    given, never on a label, a length or a repeated vector.
    """
    spark = vectors.sparkSession
    rows = written(eligible(vectors, is_anchor, id_col, label_col, vector_col, scale), "eligible")
    curves = curve(rows)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not curves or not rows.where("anchor").limit(1).count():
        return spark.createDataFrame([], result)
    on_curve = rows.mapInArrow(_on_curve(curves, CURVE_BITS), "vec_id long, label long, anchor boolean, v array<long>, dim int, h long")
    placed = dense_positions(on_curve, ["dim"], ["label", "h", "vec_id"])
    blocks = written(blocks_of(placed, block_rows), "blocks")
    pages = {r.dim: r.n for r in blocks.groupBy("dim").agg((F.floor(F.max("block") / page_blocks) + 1).cast("int").alias("n")).collect()}
    floors = blocks.select("ids", "labels", "anchors", "v").mapInArrow(_home_floor(positives), "vec_id long, floor long")
    numbered = dense_positions(placed.where("anchor"), ["dim"], ["position"], "no")
    anchors = numbered.join(floors, "vec_id").select("vec_id", "label", "v", "dim", F.floor(F.col("no") / anchor_rows).alias("grp"), "floor")
    anchors = written(anchors, "anchors")
    first = anchors.withColumn("lows", F.array("floor")).withColumn("highs", F.array(F.lit(MOST).cast("long")))
    found = search_windows(blocks, first, True, positives, pages, reader_blocks, page_blocks)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = found.select("anchor_id", (F.row_number().over(best) - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = written(near.where(F.col("slot") < positives), "positives")
    scores = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("p"))
    exact = lambda x: x.getField("positive_score").cast("decimal(38,0)")
    low = F.transform("p", lambda x: F.when(exact(x) < 0, F.lit(1)).otherwise(F.ceil(exact(x) * least_percent / 100)).cast("long"))
    high = F.transform("p", lambda x: F.when(exact(x) < 0, F.lit(0)).otherwise(F.floor(exact(x) * most_percent / 100)).cast("long"))
    blank = lambda v: F.array_repeat(F.lit(v).cast("long"), F.lit(positives) - F.size("p"))
    windows = scores.select("vec_id", F.concat(low, blank(1)).alias("lows"), F.concat(high, blank(0)).alias("highs"))
    second = anchors.drop("floor").join(windows, "vec_id")
    found = search_windows(blocks, second, False, negatives, pages, reader_blocks, page_blocks)
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.join(near, ["anchor_id", "slot"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                                                          F.col("score").alias("negative_score"))
