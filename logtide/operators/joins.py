"""Event-time interval join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                  before_ms: int, after_ms: int, grace: str | None = None) -> DataFrame:
    """Pairs with equal keys and ``left_ts - before <= right_ts <= left_ts + after``.

    Both bounds are inclusive. Other than ``keys``, the sides' columns must have different
    names. On streams, give ``grace``: it becomes the watermark delay of both sides.

    An equi-join on the keys alone would compare every pair of a hot key. The time axis is
    therefore cut into buckets as wide as the interval and made part of the join key: each
    right row goes to the at most two buckets its partners can be in, so a hot key spreads
    over its buckets and only rows near each other in time meet.
    """
    if grace is not None:
        left, right = left.withWatermark(left_ts, grace), right.withWatermark(right_ts, grace)
    width = F.lit((before_ms + after_ms + 1) * 1000)
    lo = F.unix_micros(right_ts) - F.lit(after_ms * 1000)
    hi = F.unix_micros(right_ts) + F.lit(before_ms * 1000)
    l = left.withColumn("_bucket", F.floor(F.unix_micros(left_ts) / width))
    r = right.withColumn("_bucket", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))
    near = F.expr(
        f"{right_ts} >= {left_ts} - INTERVAL {before_ms / 1000:.3f} SECONDS"
        f" AND {right_ts} <= {left_ts} + INTERVAL {after_ms / 1000:.3f} SECONDS")
    matched = [l[k] == r[k] for k in [*keys, "_bucket"]]
    cond = near
    for m in matched:
        cond = m & cond
    joined = l.join(r, cond, "inner")
    return joined.select(
        *[l[c] for c in left.columns], *[r[c] for c in right.columns if c not in keys])
