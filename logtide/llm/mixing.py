"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.operators.ordered import dense_positions
from logtide.session import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """``source, source_size, target`` from rows of (source, size).

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes by them. A target
    stops at ``most`` times its source's size; the excess is shared again by weight until no target is above. Each round
    aggregates two scalars over the sources and caps at least one more source, so it ends.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull())
    ranked = dense_positions(sums, [], ["_last", "source"], "_at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights)).cast("int") + 1)
    table = written(ranked.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * most).alias("_cap")), "sources")
    level, capped = 0.0, -1
    while True:
        over = F.col("_weight") * level > F.col("_cap")
        total, held, free, n = table.agg(
            F.sum("source_size"), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_weight"))), F.count_if(over)).first()
        if n == capped or not free:
            break
        level, capped = (total - (held or 0.0)) / free, n
    return table.select("source", "source_size", F.least(F.col("_weight") * level, F.col("_cap")).alias("target"))


KEY = ["k1", "k2", "rank"]


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """``doc_id, source, size, k1, k2``: the hashes are equal for rows that agree in id, source and text."""
    row = [F.col(id_col), F.col(source_col), F.col(text_col)]
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
                       F.xxhash64(*row).alias("k1"), F.xxhash64(F.lit(1), *row[::-1]).alias("k2"), *more)


def _ranked(rows: DataFrame, repeated: bool) -> DataFrame:
    """``rows`` with ``rank``, a number from 0 that tells equal rows apart. Numbered by a sort over the cluster, however many
    there are of one; the key takes part in the range, so a third of all rows being equal is no long task."""
    if not repeated:
        return rows.withColumn("rank", F.lit(0).cast("long"))
    return dense_positions(rows.withColumn("_no", F.monotonically_increasing_id()), ["k1", "k2"], ["_no"], "rank").drop("_no")


def inclusion(sizes: DataFrame, targets: DataFrame, preference: Column) -> DataFrame:
    """``source, _c``: the factor by which ``preference`` becomes the probability of the extra copy.

    Such that the expected words of the extra copies are what is left of the target; probabilities end below 1, and what
    they lose is shared among the others. ``sizes`` has a row per source and size, with the number of documents; each
    round aggregates it to one row per source.
    """
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    need = (copies - F.floor(copies)) * F.col("source_size")
    at = written(sizes.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", preference.alias("_w"), (F.col("size") * F.col("docs")).alias("_words"), need.alias("_need")), "preferences")
    words, factors, full = F.col("_words"), None, -1
    while True:
        known = at.withColumn("_c", F.lit(0.0)) if factors is None else at.join(
            factors.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        sure = F.col("_c") * F.col("_w") >= 1
        sums = known.groupBy("source").agg(F.first("_need").alias("_need"), F.sum(F.when(sure, words).otherwise(0)).alias("_sure"),
                                           F.sum(F.when(~sure, words * F.col("_w")).otherwise(0)).alias("_open"), F.count_if(sure).alias("_full"),
                                           F.max("_c").alias("_old"))
        left = F.greatest(F.col("_need") - F.col("_sure"), F.lit(0.0))
        factor = F.when(F.col("_open") > 0, F.greatest(F.col("_old"), left / F.col("_open"))).otherwise(F.col("_old"))
        factors = written(sums.select("source", factor.alias("_c"), "_full"), "factors")
        now = factors.agg(F.sum("_full")).first()[0] or 0
        factors = factors.select("source", "_c")
        if now == full:  # each round makes one more size of some source certain, or is the last
            return factors
        full = now


def _shares(targets: DataFrame, factors: DataFrame) -> DataFrame:
    """One row per source, written: a join with it needs no shuffle of the documents, as its size is known."""
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    return written(t.join(factors.withColumnRenamed("source", "_f"), F.col("_s").eqNullSafe(F.col("_f"))).drop("_f"), "shares")


def _drawn(rows: DataFrame, shares: DataFrame, preference: Column, seed: int) -> DataFrame:
    """Adds whole copies, the words still needed, and ``_y``: random odds over inclusion odds, mapped to (0, 1)."""
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    p = F.greatest(F.least(F.col("_c") * preference, F.lit(1 - 1e-9)), F.lit(1e-9))
    u = (F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = (u / (1 - u)) / (p / (1 - p))
    joined = rows.join(shares, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return joined.withColumn("_whole", F.floor(copies)).withColumn("_need", (copies - F.floor(copies)) * F.col("source_size")).withColumn(
        "_y", odds / (1 + odds)).drop("_c")


def cuts(drawn: DataFrame) -> DataFrame:
    """Per source, the last document in Pareto order that the sample takes: ``source, _low_y, _cut``.

    The order is not sorted: sizes are summed per source in ``BUCKETS`` intervals of the order, then in as many parts of
    the interval in which the wanted words run out; only the few rows of that part are put in order. So a source that
    holds a third of all rows costs a map-side aggregate, not one long task.
    """
    rows = drawn.select("source", "size", *KEY, "_need", "_y").withColumn("_b1", F.floor(F.col("_y") * BUCKETS))
    by = ["source", "_need"]
    first = _boundary(rows.groupBy(*by, "_b1").agg(F.sum("size").alias("_n")), "_b1", F.lit(0))
    inside = _meet(rows, first, "_b1").withColumn("_b2", F.floor((F.col("_y") * BUCKETS - F.col("_b1")) * BUCKETS))
    second = _boundary(inside.groupBy(*by, "_b2", "_before").agg(F.sum("size").alias("_n")), "_b2", F.col("_before"))
    last = _meet(inside.drop("_before"), second, "_b2")
    up_to = Window.partitionBy("source").orderBy("_y", *KEY).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("size").over(up_to), F.lit(0))
    taken = last.select("source", "_y", *KEY, (before + F.col("size") / 2 <= F.col("_need")).alias("_in")).where("_in")
    edge = taken.groupBy(F.col("source").alias("_s")).agg(F.max(F.struct("_y", *KEY)).alias("_cut"))
    start = second.select("source", (F.col("_lo")).alias("_part")).join(
        first.select(F.col("source").alias("_s"), F.col("_lo").alias("_whole_part")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    low = (F.col("_whole_part") + F.col("_part") / BUCKETS) / BUCKETS
    return written(start.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", low.alias("_low_y"), "_cut"), "cuts")


def _boundary(sums: DataFrame, bucket: str, base: Column) -> DataFrame:
    """The interval in which the running sum passes the need; at most ``BUCKETS`` rows per source are summed."""
    up_to = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    at = sums.withColumn("_lo_sum", base + F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
    return written(at.where("_lo_sum <= _need AND _need < _lo_sum + _n").select(
        "source", F.col(bucket).alias("_lo"), F.col("_lo_sum").alias("_before")), "boundary")


def _meet(rows: DataFrame, boundary: DataFrame, bucket: str) -> DataFrame:
    b = boundary.withColumnRenamed("source", "_s")
    return rows.join(b, F.col("source").eqNullSafe(F.col("_s")) & (F.col(bucket) == F.col("_lo"))).drop("_s", "_lo")


def _copies(drawn: DataFrame, at: DataFrame) -> DataFrame:
    """``drawn`` with ``copies``: certain whole copies plus one if the sample takes the document."""
    joined = drawn.join(at.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    in_sample = (F.col("_y") < F.col("_low_y")) | (F.struct("_y", *KEY) <= F.col("_cut"))
    return joined.withColumn("copies", F.coalesce(F.col("_whole") + F.coalesce(in_sample, F.lit(False)).cast("long"), F.lit(0)).cast("long"))


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], most: float, preference: Column, seed: int):
    """Narrow rows with everything but copies, whether rows repeat, and per source its targets, factors, shares and cuts."""
    narrow = written(_keyed(docs, id_col, text_col, source_col), "sized")
    repeated = not narrow.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    ranked = _ranked(narrow, repeated)
    targets = written(source_targets(narrow, weights, most), "targets")
    sizes = narrow.groupBy("source", "size").agg(F.count("*").alias("docs"))
    factors = inclusion(sizes, targets, preference)
    shares = _shares(targets, factors)
    drawn = _drawn(ranked, shares, preference, seed)
    return drawn, repeated, factors, shares, cuts(drawn)


def by_length() -> Column:
    """The preference of the extra copy: the square root of the size, so long documents are drawn more often."""
    return F.sqrt(F.col("size").cast("double"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, preference: Column | None = None, seed: int = 17) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    A document is taken floor(target / source size) times for certain. For the rest of the target it is drawn with a
    probability in proportion to ``preference`` (a column over ``source`` and ``size``; by default ``by_length``), by a
    Pareto sample per source: random odds over inclusion odds, smallest first, as many as bring the source's words nearest
    to its target. Random numbers are hashes of the row, so reruns agree.

    Null or empty texts have size 0 and add nothing. Null sources are one source, the last. Null and repeated ids are
    documents of their own: a random number belongs to id, source and text, and to a number among rows that agree in all
    three. Empty tables give no rows. Other columns of ``docs`` are not read.
    """
    liked = by_length() if preference is None else preference
    drawn, _, _, _, at = _plan(docs, id_col, text_col, source_col, weights, most, liked, seed)
    return _copies(drawn, at).select("doc_id", "source", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), "copies")


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, preference: Column | None = None, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, ...), each as often as the mix takes it. Rows move only if some repeat."""
    liked = by_length() if preference is None else preference
    _, repeated, _, shares, at = _plan(docs, "doc_id", "text", "source", weights, most, liked, seed)
    wide = _ranked(_keyed(docs, "doc_id", "text", "source", F.struct("*").alias("row")), repeated)
    counted = _copies(_drawn(wide, shares, liked, seed), at)
    taken = counted.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
