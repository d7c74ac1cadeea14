"""Parquet table loader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide.session import use_utc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``<folder>/<name>.parquet`` with zone-less timestamps read as UTC instants.

    Watermarks and event-time windows need instants; other columns pass through, so
    column pruning and filters still reach the scan.
    """
    use_utc(spark)
    df = spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])
