"""Session helpers: UTC sessions, the shared scratch folder, written intermediates."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "logtide", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; on a cluster, leave ``master`` to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return use_utc(b.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are instants; every date or minute boundary in here is a UTC one."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; unset, a folder of the warehouse, which they share too."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other write uses."""
    app = spark.sparkContext.applicationId
    return os.path.join(scratch_dir(spark), "logtide", app, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the scratch folder and continue from the written table.

    Cuts the lineage so that a lost executor re-reads files instead of repeating the
    plan, and pins any row ids that the plan computed from its physical layout.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
