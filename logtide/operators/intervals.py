"""Sets of log positions as ranges, cut into blocks of positions.

A range never crosses a block, and a block holds at most ``block_rows`` positions, so the windows below never see more
than that many rows of one log partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 1_000_000


def block_of(offset: str, block_rows: int = BLOCK_ROWS) -> Column:
    return F.floor(F.col(offset) / F.lit(block_rows)).cast("bigint")


def to_ranges(rows: DataFrame, keys: list[str], offset: str, at: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``keys, block, from_offset, to_offset, processed_at``: runs of neighbouring offsets (distinct per key) as one row each."""
    cut = rows.withColumn("block", block_of(offset, block_rows))
    along = Window.partitionBy(*keys, "block").orderBy(offset)
    runs = cut.withColumn("_run", F.col(offset) - F.row_number().over(along))
    return runs.groupBy(*keys, "block", "_run").agg(
        F.min(offset).alias("from_offset"), F.max(offset).alias("to_offset"), F.max(at).cast("timestamp").alias("processed_at")).drop("_run")


def merge_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges that touch or overlap inside a block as one."""
    before = Window.partitionBy(*keys, "block").orderBy("from_offset", "to_offset").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys, "block").orderBy("from_offset", "to_offset").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("to_offset").over(before)
    opened = ranges.withColumn("_new", F.when(reach.isNull() | (F.col("from_offset") > reach + 1), 1).otherwise(0))
    return opened.withColumn("_run", F.sum("_new").over(upto)).groupBy(*keys, "block", "_run").agg(
        F.min("from_offset").alias("from_offset"), F.max("to_offset").alias("to_offset")).drop("_run")


def outside_ranges(rows: DataFrame, ranges: DataFrame, keys: list[str], offset: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows whose offset lies in none of the ranges.

    Ranges and rows are sorted together by position: a row is inside if the farthest end of the ranges that begin at or
    before it reaches it. Nothing is expanded and no pair of row and range is made.
    """
    marks = ranges.select(*keys, "block", F.col("from_offset").alias("_at"), F.lit(0).alias("_kind"), F.col("to_offset").alias("_end"))
    cut = rows.select(*keys, block_of(offset, block_rows).alias("block"), F.col(offset).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    both = cut.unionByName(marks, allowMissingColumns=True)
    upto = Window.partitionBy(*keys, "block").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = both.withColumn("_reach", F.max("_end").over(upto))
    return reach.where((F.col("_kind") == 1) & (F.col("_reach").isNull() | (F.col("_reach") < F.col("_at")))).select("_row.*")
