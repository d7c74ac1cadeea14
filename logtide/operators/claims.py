"""Claim check: large payloads live in a blob table, the log keeps a reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: largest record a broker accepts by default, in bytes.
MAX_RECORD_BYTES = 1_048_588


def digest(blobs: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """(key, sha256, bytes) of each blob, computed where it is read.

    Joins use this instead of the content, so payloads are never shuffled.
    """
    return blobs.select(
        F.col(key).alias("key"), F.sha2(content, 256).alias("actual_checksum"),
        F.octet_length(content).cast("bigint").alias("actual_bytes"))


def redeem(refs: DataFrame, blobs: DataFrame) -> DataFrame:
    """References (key, size_bytes, checksum, ...) with status OK, MISMATCH or MISSING."""
    same = (F.col("actual_checksum") == F.col("checksum")) & (F.col("actual_bytes") == F.col("size_bytes"))
    return refs.join(digest(blobs), "key", "left").select(
        *refs.columns,
        F.when(F.col("actual_checksum").isNull(), "MISSING").when(same, "OK").otherwise("MISMATCH").alias("status"))


def classify(df: DataFrame, content: str, max_bytes: int, record_limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """Add ``bytes``, ``kind`` and, for references, the ``checksum`` of the payload.

    ``reference`` payloads are over ``max_bytes`` and leave the log; ``rejected`` ones
    would stay but are over the broker's record limit, which is possible only when
    ``max_bytes`` is above it; all others are ``inline``.
    """
    size = F.octet_length(content).cast("bigint")
    large = size > max_bytes
    kind = F.when(large, "reference").when(size > record_limit, "rejected").otherwise("inline")
    return df.select("*", size.alias("bytes"), kind.alias("kind"), F.when(large, F.sha2(content, 256)).alias("checksum"))


def offload(df: DataFrame, key: str, content: str, event_id: Column, bucket: str, content_type: str,
            max_bytes: int, record_limit: int = MAX_RECORD_BYTES) -> dict[str, DataFrame]:
    """The frames to write for each kind: ``inline``, ``rejected``, ``blobs`` and ``references``.

    ``blobs`` (key, content) and ``references`` (key, value) replace the large payloads.
    """
    parts = classify(df, content, max_bytes, record_limit)
    large = parts.filter("kind = 'reference'")
    reference = F.to_json(F.struct(
        event_id.alias("eventId"), F.lit(bucket).alias("bucket"), F.col(key).alias("key"),
        F.col("bytes").alias("sizeBytes"), "checksum", F.lit(content_type).alias("contentType")))
    return {
        "inline": parts.filter("kind = 'inline'").select(*df.columns),
        "rejected": parts.filter("kind = 'rejected'").select(*df.columns),
        "blobs": large.select(F.col(key).alias("key"), F.col(content).alias("content")),
        "references": large.select(F.col(key).alias("key"), reference.alias("value")),
    }
