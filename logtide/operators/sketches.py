"""Heavy hitters from mergeable sketches: keys that may be hot are found without counting every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRACKED = 10_000


def smallest_share(tracked: int = TRACKED) -> float:
    """Every key with a larger share of the rows is sure to be among a sketch's candidates.

    A frequent-items sketch for ``tracked`` items has a map of the next power of two above tracked / 0.75 and errs by at
    most 3.5 / map size of all rows; a key is reported for sure once its count is above twice the error.
    """
    size = 1
    while size < tracked / 0.75:
        size *= 2
    return 2 * 3.5 / size


def key_sketches(rows: DataFrame, key: str, window: Column, tracked: int = TRACKED) -> DataFrame:
    """``window_start, sketch, records``: one mergeable sketch of the keys per window, to be stored.

    Sketches are built in the tasks and merged, so what is shuffled is their size times the number of windows and not the
    number of keys.
    """
    return rows.groupBy(window.alias("window_start")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"), F.count("*").alias("records"))


def merged_sketch(sketches: DataFrame, tracked: int = TRACKED, by: list[str] | None = None) -> DataFrame:
    """Stored sketches of several windows as one (one per value of ``by``), with their rows summed."""
    return sketches.groupBy(*(by or [])).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("records").alias("records"))


def candidates(sketch: DataFrame, min_share: float, tracked: int = TRACKED, by: list[str] | None = None) -> DataFrame:
    """``key, total`` (and ``by``): keys whose share may be above ``min_share``, at most ``tracked`` of them per sketch.

    The estimate never falls below the true count by more than half of ``smallest_share``, which must be below
    ``min_share``; none that reaches it is missed.
    """
    if smallest_share(tracked) > min_share:
        raise ValueError(f"a sketch of {tracked} items finds shares above {smallest_share(tracked):.3g} only, asked for {min_share:.3g}")
    items = sketch.select(*(by or []), F.col("records").alias("total"), F.inline(F.expr(f"approx_top_k_estimate(sketch, {tracked})")))
    slack = F.col("total") * (smallest_share(tracked) / 2)
    return items.where(F.col("count") + slack >= F.col("total") * min_share).select(*(by or []), F.col("item").alias("key"), "total")


def hot_keys_sketched(rows: DataFrame, key: str, sketches: DataFrame, min_share: float, tracked: int = TRACKED, window: Column | None = None) -> DataFrame:
    """``key, records, share`` (and ``window_start``): exactly the keys above ``min_share`` of the rows, as ``hot_keys`` gives them.

    The sketches of ``rows`` name the candidates; only these are counted again. Candidates are few, at most ``tracked`` and
    about 1 / min_share a sketch, so the join is broadcast and rows of other keys end in the scan.
    """
    by = ["window_start"] if window is not None else None
    known = F.broadcast(candidates(merged_sketch(sketches, tracked, by), min_share, tracked, by))
    named = rows.select(*([window.alias("window_start")] if window is not None else []), F.col(key).alias("key"))
    counted = named.join(known, [*(by or []), "key"]).groupBy(*(by or []), "key").agg(F.count("*").alias("records"), F.first("total").alias("total"))
    return counted.withColumn("share", F.col("records") / F.col("total")).where(F.col("share") > min_share).drop("total")
