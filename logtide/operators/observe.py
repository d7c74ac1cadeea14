"""Lag, counter rates, alert states and throughput over logs and metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.operators.ordered import chunked_lag, chunked_running_max, time_chunk, trailing_sum
from logtide.session import written


def log_ends(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("log_end"))


def consumer_lag(log: DataFrame, offsets: DataFrame) -> DataFrame:
    """Lag per (group, topic, partition); with no commit yet the whole log is behind."""
    return offsets.join(log_ends(log), ["topic", "partition"], "left").select(
        "consumer_group", "topic", "partition", "committed",
        F.coalesce("log_end", F.lit(0).cast("bigint")).alias("log_end"),
        (F.coalesce("log_end", F.lit(0).cast("bigint")) - F.coalesce("committed", F.lit(0).cast("bigint"))).alias("lag"))


def group_lag(lag: DataFrame) -> DataFrame:
    return lag.groupBy("consumer_group").agg(F.sum("lag").alias("lag"))


def counter_deltas(samples: DataFrame, series: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Increase of a counter since the sample before; after a reset, the value itself.

    The first sample of a series has no predecessor and so no increase.
    """
    lagged = chunked_lag(samples, series, [ts], [value], time_chunk(ts))
    before = F.col(f"prev_{value}")
    return lagged.withColumn(
        "delta", F.when(before.isNull(), F.lit(0.0)).when(F.col(value) < before, F.col(value))
        .otherwise(F.col(value) - before)).drop(f"prev_{value}")


def counter_increase(samples: DataFrame, series: list[str], seconds: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """Increase over the trailing window at each sample, without extrapolation."""
    return trailing_sum(counter_deltas(samples, series, ts, value), series, ts, "delta", seconds, "increase").drop("delta")


def counter_rate(samples: DataFrame, series: list[str], seconds: int, by: list[str], ts: str = "ts",
                 value: str = "value") -> DataFrame:
    """Per-second rate over aligned windows, summed over the series of each group."""
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))
    return counter_deltas(samples, series, ts, value).groupBy(*by, bucket.alias("window_start")).agg(
        (F.sum("delta") / F.lit(float(seconds))).alias("rate"))


def alert_states(samples: DataFrame, series: list[str], condition: Column, hold_seconds: int, ts: str = "ts") -> DataFrame:
    """``inactive`` / ``pending`` / ``firing`` at each evaluation of a sustained condition.

    The streak starts at the first true evaluation after a false one; the alert fires once
    it has lasted ``hold_seconds``. The two ordered steps each read their input twice, for
    the rows and for the chunk borders, so each input is written first: chained lazily,
    they would repeat the whole plan under them four times.
    """
    checked = written(samples.withColumn("_on", F.coalesce(condition, F.lit(False))), "alert-checks")
    lagged = chunked_lag(checked, series, [ts], ["_on"], time_chunk(ts), "_prev")
    starts = written(lagged.withColumn(
        "_start", F.when(F.col("_on") & ~F.coalesce(F.col("_prev_on"), F.lit(False)), F.col(ts))), "alert-starts")
    streaks = chunked_running_max(starts, series, [ts], "_start", time_chunk(ts), "_since")
    held = (F.unix_micros(ts) - F.unix_micros("_since")) >= F.lit(hold_seconds * 1_000_000)
    return streaks.select(
        *samples.columns,
        F.when(~F.col("_on"), "inactive").when(held, "firing").otherwise("pending").alias("state"))


def throughput(log: DataFrame, by: list[str], at: str = "timestamp", value: str = "value") -> DataFrame:
    """Messages, bytes, elapsed seconds (1 ms at least), rates and mean size per group."""
    size = F.octet_length(value)
    millis = F.greatest(F.max(F.unix_millis(at)) - F.min(F.unix_millis(at)), F.lit(1).cast("bigint"))
    sums = log.groupBy(*by).agg(
        F.count("*").alias("messages"), F.coalesce(F.sum(size), F.lit(0).cast("bigint")).alias("bytes"),
        (millis / 1000.0).alias("elapsed_seconds"))
    return sums.select(
        "*", (F.col("messages") / F.col("elapsed_seconds")).alias("messages_per_second"),
        (F.col("bytes") / F.lit(1024.0 * 1024.0) / F.col("elapsed_seconds")).alias("mb_per_second"),
        (F.col("bytes") / F.col("messages")).alias("avg_bytes"))


def share_of_total(df: DataFrame, by: str) -> DataFrame:
    """Count per group and its share of all rows, in one scan; for attributes with few values, whose counts meet in one task."""
    counts = df.groupBy(by).agg(F.count("*").alias("records"))
    return counts.withColumn("share", F.col("records") / F.sum("records").over(Window.partitionBy(F.lit(0))))
