"""Key placement over DataFrames: distribution, hot keys, salting, plan sweep, audit."""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtide.functions.hashing import murmur2, partition_for, placement, salted


def assign_partitions(df: DataFrame, key: str, partitions: int, partitioner=partition_for,
                      name: str = "partition") -> DataFrame:
    """Add the partition of each key; ``partitioner`` is (key, partitions) -> Column."""
    return df.withColumn(name, partitioner(F.col(key), partitions))


def salt_keys(df: DataFrame, key: str, is_hot: Column, buckets: int, ordinal: str, name: str = "salted_key") -> DataFrame:
    return df.withColumn(name, salted(F.col(key), F.col(ordinal), buckets, is_hot))


def partition_distribution(log: DataFrame, partitions: int, partition: str = "partition",
                           healthy_share: float = 0.2, records: str | None = None) -> DataFrame:
    """Rows, share, over-share flag per partition, and which partition is the worst.

    With ``records``, a row stands for so many (say a key and its count), so that keys are placed once and not per record.

    Every partition of the topic is listed, and so is every other number that records carry, null included: those are
    strays, and count in the shares. An empty topic has shares 0 and no worst one.
    """
    n = F.sum(records) if records else F.count("*")
    counts = log.groupBy(F.col(partition).cast("bigint").alias("partition")).agg(n.alias("n"))
    every = log.sparkSession.range(partitions).select(F.col("id").alias("partition"))
    loads = every.join(counts, "partition", "full_outer").select(
        "partition", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("records"))
    # One row per partition of the topic, so a window over all of them is small.
    topic = Window.partitionBy(F.lit(0))
    total = F.sum("records").over(topic)
    # Largest count first, lowest partition number among equals.
    worst = F.max(F.when(F.col("partition").isNotNull(), F.struct("records", (-F.col("partition")).alias("p")))).over(topic)
    share = F.when(total > 0, F.col("records") / total).otherwise(F.lit(0.0))
    return loads.select("partition", "records", share.alias("share"), (-worst["p"]).alias("_worst"), total.alias("_t")).select(
        "partition", "records", "share", (F.col("share") > healthy_share).alias("over_healthy"),
        (F.col("partition").eqNullSafe(F.col("_worst")) & F.col("partition").isNotNull() & (F.col("_t") > 0)).alias("is_worst"))


def key_counts(df: DataFrame, key: str, window: Column | None = None) -> DataFrame:
    by = ([window.alias("window_start")] if window is not None else []) + [F.col(key).alias("key")]
    return df.groupBy(*by).agg(F.count("*").alias("records"))


def hot_keys(df: DataFrame, key: str, min_share: float, window: Column | None = None) -> DataFrame:
    """Keys above a share of all records (of their time window when one is given).

    Counts are pre-aggregated per task; totals are taken from the counts, not the rows. Where counting every key is too
    much, see ``logtide.operators.sketches``.
    """
    counts = key_counts(df, key, window)
    if window is None:
        total = counts.agg(F.sum("records")).scalar()
        shared = counts.withColumn("share", F.col("records") / total)
    else:
        totals = counts.groupBy("window_start").agg(F.sum("records").alias("_total"))
        shared = counts.join(totals, "window_start").withColumn("share", F.col("records") / F.col("_total")).drop("_total")
    return shared.filter(F.col("share") > min_share)


def salt_sweep(df: DataFrame, key: str, ordinal: str, is_hot: Column, partitions: list[int],
               buckets: list[int]) -> DataFrame:
    """Worst partition share of every (partition count, salt buckets) plan on real keys.

    Rows are first counted by (key, ordinal mod lcm of the bucket counts), which fixes the
    salted key under every plan; only those counts are expanded and hashed, so the sweep
    costs one pass over the rows however many plans it compares.
    """
    cycle = lcm(*[b for b in buckets if b > 0] or [1])
    counted = df.groupBy(
        F.col(key).alias("key"), is_hot.alias("hot"),
        F.when(is_hot, F.pmod(F.col(ordinal), F.lit(cycle))).otherwise(F.lit(0)).alias("turn"),
    ).agg(F.count("*").alias("n"))
    per_salt = counted.withColumn("salt_buckets", F.explode(F.array(*[F.lit(b) for b in buckets])))
    keys = per_salt.groupBy(
        "salt_buckets",
        F.when(F.col("hot") & (F.col("salt_buckets") > 0),
               F.concat("key", F.lit("#"), F.pmod("turn", F.greatest("salt_buckets", F.lit(1))).cast("string")))
        .otherwise(F.col("key")).alias("placed_key"),
    ).agg(F.sum("n").alias("n"))
    placed = keys.withColumn("h", murmur2(F.col("placed_key"))).withColumn(
        "partitions", F.explode(F.array(*[F.lit(p) for p in partitions])))
    loads = placed.groupBy("partitions", "salt_buckets", placement(F.col("h"), F.col("partitions")).alias("p")).agg(
        F.sum("n").alias("load"))
    return loads.groupBy("partitions", "salt_buckets").agg(
        (F.max("load") / F.sum("load")).alias("worst_share"))


def salted_sum(df: DataFrame, key: str, value: str, is_hot: Column, buckets: int, ordinal: str) -> DataFrame:
    """Sum and count per key in two phases: by salted key, then by the key itself."""
    first = (
        df.withColumn("_salted", salted(F.col(key), F.col(ordinal), buckets, is_hot))
        .groupBy("_salted", F.col(key).alias("key")).agg(F.sum(value).alias("_s"), F.count("*").alias("_n"))
    )
    return first.groupBy("key").agg(F.sum("_s").alias("total"), F.sum("_n").alias("records"))


def copartition_report(left: DataFrame, right: DataFrame, key: str = "key", partition: str = "partition") -> DataFrame:
    """Whether two keyed logs may be joined partition by partition.

    One row: distinct partitions per side, keys found on both sides, keys placed
    differently, and the verdict.
    """
    def homes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("key")).agg(
            F.min(partition).alias(f"{name}_lo"), F.max(partition).alias(f"{name}_hi"))

    def width(df: DataFrame):
        return df.agg(F.coalesce(F.max(partition) + 1, F.lit(0))).scalar()

    agree = (F.col("l_lo") == F.col("r_lo")) & (F.col("l_hi") == F.col("r_hi")) & (F.col("l_lo") == F.col("l_hi"))
    shared = homes(left, "l").join(homes(right, "r"), "key")
    return (
        shared.agg(F.count("*").alias("shared_keys"), F.count_if(~agree).alias("misplaced_keys"))
        .select(width(left).alias("left_partitions"), width(right).alias("right_partitions"),
                "shared_keys", "misplaced_keys")
        .withColumn("verdict",
                    F.when(F.col("left_partitions") != F.col("right_partitions"), "different partition counts")
                    .when(F.col("misplaced_keys") > 0, "different partitioner")
                    .otherwise("co-partitioned"))
    )
