"""Incremental table reads: rows above a high-water mark, and the next mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def incremental_read(df: DataFrame, cursor: str, last) -> DataFrame:
    """Rows with ``cursor > last``; the predicate reaches the scan. ``None`` reads all."""
    return df if last is None else df.filter(F.col(cursor) > F.lit(last))


def next_mark(rows: DataFrame, cursor: str, last):
    """Mark to store after ``rows`` are handled: their highest cursor, or ``last`` when empty."""
    top = rows.agg(F.max(cursor)).first()[0]
    return last if top is None else top


def jdbc_incremental_options(url: str, table: str, cursor: str, last: int | None, upper: int,
                             partitions: int, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a parallel JDBC read of the rows in ``(last, upper]``.

    ``upper`` is the mark to reach, read once by the caller, so that rows inserted while
    the partitions are being read are left to the next poll.
    """
    low = "" if last is None else f"{cursor} > {last} AND "
    return {
        "url": url, "dbtable": f"(SELECT * FROM {table} WHERE {low}{cursor} <= {upper}) polled",
        "partitionColumn": cursor, "lowerBound": str(0 if last is None else last), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
