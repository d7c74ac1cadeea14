"""Line files and blobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One record per line. A stream takes whole new files; it does not tail an open one."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(F.col("value").alias("line"))


def read_blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(key, content) of the files under ``path``; the key is the path below it."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load(path)
    )
    root = path.rstrip("/") + "/"
    return files.select(F.substring_index("path", root, -1).alias("key"), "content")


def raw_landing(log: DataFrame) -> DataFrame:
    """Bronze rows: the value as it came, unvalidated, with its coordinates and size."""
    return log.select("topic", "partition", "offset", F.col("value").alias("raw"),
                      F.octet_length("value").cast("bigint").alias("raw_bytes"))
