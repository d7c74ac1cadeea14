"""File and JDBC sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide.operators.decode import parse_split, with_reject_reason
from logtide.operators.gate import GateReport, common_type, evolve, fitted, require_compatible


def write_with_quarantine(log: DataFrame, good_path: str, bad_path: str) -> None:
    """Parsed values to ``good_path``, one per line; broken records to ``bad_path``."""
    good, bad = parse_split(log)
    good.select("value").write.mode("append").text(good_path)
    bad.write.mode("append").parquet(bad_path)


def write_sorted_out(log: DataFrame, path: str) -> None:
    """Values to ``path/sink=file``, one per line; broken records as JSON lines with their reason to ``path/sink=quarantine``.

    One pass: every value is parsed once and every record written once. Line ends inside a value are blanks between its
    tokens, since JSON strings cannot hold them, and become spaces.
    """
    tagged = with_reject_reason(log)
    bad = F.to_json(F.struct(*log.columns, "reject_reason"))
    line = F.when(F.col("reject_reason").isNull(), F.regexp_replace("value", "[\r\n]", " ")).otherwise(bad)
    sink = F.when(F.col("reject_reason").isNull(), "file").otherwise("quarantine")
    tagged.select(sink.alias("sink"), line.alias("value")).write.mode("append").partitionBy("sink").text(path)


def read_sink_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(f"{path}/sink=file")


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The broken records as they came, with ``reject_reason``; ``schema`` is that of the log."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("reject_reason", T.StringType())])).json(f"{path}/sink=quarantine")


def write_clustered(df: DataFrame, path: str, partition_by: str, cluster_by: list[str], mode: str = "append") -> None:
    """Folders by ``partition_by``, rows inside each file in ``cluster_by`` order.

    Sorted files give narrow row-group ranges, so filters on the leading columns skip row
    groups. Rows are dealt by range over (partition, cluster columns): a month that holds
    most of the data is cut into many files instead of going to one task.
    """
    order = [partition_by, *cluster_by]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(partition_by).parquet(path)


def gated_append(df: DataFrame, path: str, table: T.StructType | None = None,
                 defaults: frozenset[str] = frozenset()) -> GateReport:
    """Append only what readers of the table's current schema rules allow.

    A breaking change raises before anything is written. New nullable columns evolve the
    table; columns the batch lacks are written as nulls. A numeric column may grow to a
    type that holds all its values: Parquet files of one read cannot mix numeric types, so
    the files from then on go to a folder of their own (``schema-N``), and ``read_evolved``
    reads each folder with its own types. Give the ``table`` schema where it is known:
    finding it from the files reads their footers.
    """
    spark: SparkSession = df.sparkSession
    groups = _schema_groups(spark, path)
    current = table or _merged([g.schema for _, g in groups])
    report = require_compatible(current, fitted(df.schema, current), defaults)
    batch = evolve(df, current)
    number, newest = (groups[-1][0], groups[-1][1].schema) if groups else (0, batch.schema)
    same = all(f.name not in newest.fieldNames() or newest[f.name].dataType == f.dataType for f in batch.schema.fields)
    batch.write.mode("append").parquet(_group_path(path, number if same else number + 1))
    return report


def _group_path(path: str, number: int) -> str:
    return path if number == 0 else f"{path}/schema-{number}"


def _schema_groups(spark: SparkSession, path: str) -> list[tuple[int, DataFrame]]:
    """The files of the table itself, and those of each folder ``schema-N``, in the order in which they were begun."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [f.getPath().getName() for f in store.listStatus(at)] if store.exists(at) else []
    numbers = sorted(int(n.removeprefix("schema-")) for n in names if n.startswith("schema-"))
    whole = [0] if any(n.endswith(".parquet") for n in names) else []
    return [(n, spark.read.option("mergeSchema", "true").parquet(_group_path(path, n))) for n in whole + numbers]


def _merged(schemas: list[T.StructType]) -> T.StructType:
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            fields[f.name] = (common_type(fields[f.name], f.dataType) if f.name in fields else None) or f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files have several schema versions: every column in the widest type it ever had, nulls where it lacked.

    Each folder of files is read with the types it was written with and cast afterwards; filters still reach its scan.
    """
    groups = _schema_groups(spark, path)
    schema = _merged([g.schema for _, g in groups])
    parts = [g.select(*[(F.col(f.name) if f.name in g.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]) for _, g in groups]
    return reduce(DataFrame.unionByName, parts)


def jdbc_batch_writer(url: str, table: str, batch_rows: int = 10_000, **properties: str):
    """``foreachBatch`` function: plain inserts, the table created on first use, no key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.format("jdbc").mode("append")
         .options(url=url, dbtable=table, batchsize=str(batch_rows), **properties).save())
    return write


def codec_footprint(df: DataFrame, path: str, codecs: tuple[str, ...] = ("none", "gzip", "lz4", "zstd")) -> DataFrame:
    """Bytes of the same rows under each codec, and the ratio to no compression.

    File sizes come from a listing: only the length column is read, never the files.
    """
    spark = df.sparkSession
    out = None
    for codec in codecs:
        target = f"{path}/codec={codec}"
        df.write.mode("errorifexists").option("compression", codec).parquet(target)
        size = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
            .agg(F.sum("length").alias("bytes")).select(F.lit(codec).alias("codec"), "bytes")
        )
        out = size if out is None else out.unionByName(size)
    raw = out.filter(F.col("codec") == "none").select("bytes").scalar() if "none" in codecs else F.lit(None)
    return out.withColumn("ratio", raw / F.col("bytes"))
