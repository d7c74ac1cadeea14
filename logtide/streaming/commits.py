"""Several tables written together, without a table format.

A micro-batch writes each of its tables into ``<root>/<table>/batch_id=N`` and then a
marker into ``<root>/commits/batch_id=N``. Readers keep marked batches only. A batch that
is retried after a crash has the same id: with a marker it is skipped, without one it
overwrites its own folders, so its effects happen once. Folders without a marker belong
to an attempt that never committed.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide.operators.delivery import DELIVERY, distinct_deliveries
from logtide.operators.intervals import BLOCK_ROWS, merge_ranges, outside_ranges, to_ranges


class CommitStore:
    """A set of append-only tables that become visible batch by batch."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def is_committed(self, batch_id: int) -> bool:
        return not self.of_batches("commits", [batch_id], COMMITTED).isEmpty()

    def commit(self, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """Write all tables of a batch, then its marker. The marker is the commit point."""
        for name, df in tables.items():
            self._write(df.select(*self.schemas[name].fieldNames()), name, batch_id)
        self.mark(batch_id)

    def mark(self, batch_id: int) -> None:
        marker = self.spark.range(1).select(F.current_timestamp().alias("committed_at"))
        self._write(marker.coalesce(1), "commits", batch_id)

    def of_batches(self, name: str, batch_ids: list[int], schema: T.StructType | None = None) -> DataFrame:
        """Rows that these batches have written, found by path: what other batches wrote is not even listed."""
        full = T.StructType((schema or self.schemas[name]).fields + [T.StructField("batch_id", T.LongType())])
        paths = [p for p in (f"{self.root}/{name}/batch_id={i}" for i in batch_ids) if self._exists(p)]
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(at)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
        try:
            return self.spark.read.schema(full).option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def commits(self) -> DataFrame:
        """One row per committed batch."""
        return self._read("commits", COMMITTED)

    def committed(self, name: str, before: int | None = None) -> DataFrame:
        """Rows of committed batches, with their ``batch_id``; ``before`` leaves out later ones.

        A batch that looks at its own tables must pass its id: after a crash behind the
        marker the retry would else take its own rows for somebody else's.
        """
        rows, marks = self._read(name, self.schemas[name]), self.commits().select("batch_id")
        if before is not None:
            rows, marks = rows.filter(F.col("batch_id") < before), marks.filter(F.col("batch_id") < before)
        return rows.join(marks, "batch_id", "left_semi").select(*self.schemas[name].fieldNames(), "batch_id")

    def uncommitted(self, name: str) -> DataFrame:
        """All rows written so far, including those of attempts that never committed."""
        return self._read(name, self.schemas[name])


COMMITTED = T.StructType([T.StructField("committed_at", T.TimestampType())])
SOURCE = ["topic", "partition"]
LEDGER = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("block", T.LongType()),
    T.StructField("from_offset", T.LongType()), T.StructField("to_offset", T.LongType()), T.StructField("processed_at", T.TimestampType()),
])
RANGE = LEDGER.fieldNames()[:-1]


class IntervalLedger:
    """The deliveries that were applied, as ranges of offsets.

    A batch adds its ranges; every ``fold_every`` batches all ranges so far are merged into a base, so a batch reads one
    base and fewer than ``fold_every`` additions, however many batches there were. Both are found by path.
    """

    def __init__(self, store: CommitStore, block_rows: int = BLOCK_ROWS, fold_every: int = 8):
        self.store, self.block_rows, self.fold_every = store, block_rows, fold_every
        self.base = T.StructType([f for f in LEDGER.fields if f.name in RANGE])

    def seen(self, batch_id: int) -> DataFrame:
        """Ranges of the batches before ``batch_id``."""
        start = batch_id // self.fold_every * self.fold_every
        if start and not self.store._exists(f"{self.store.root}/ledger-base/batch_id={start}"):
            return self.store.committed("ledger", before=batch_id).select(*RANGE)  # batch ids that do not follow each other
        recent = list(range(start, batch_id))
        marks = self.store.of_batches("commits", recent, COMMITTED).select("batch_id")
        added = self.store.of_batches("ledger", recent).join(marks, "batch_id", "left_semi").select(*RANGE)
        return self.store.of_batches("ledger-base", [start] if start else [], self.base).select(*RANGE).unionByName(added)

    def fresh(self, deliveries: DataFrame, batch_id: int) -> DataFrame:
        """The deliveries that no earlier batch has applied."""
        return outside_ranges(deliveries, self.seen(batch_id), SOURCE, "offset", self.block_rows)

    def add(self, fresh: DataFrame, batch_id: int, at: str) -> None:
        """Write the ranges of a batch, and the next base when its time has come. Both are redone if the batch is."""
        self.store._write(to_ranges(fresh, SOURCE, "offset", at, self.block_rows).select(*LEDGER.fieldNames()), "ledger", batch_id)
        if (batch_id + 1) % self.fold_every == 0:
            own = self.store.of_batches("ledger", [batch_id]).select(*RANGE)
            self.store._write(merge_ranges(self.seen(batch_id).unionByName(own), SOURCE), "ledger-base", batch_id + 1)


def idempotent_batch(store: CommitStore, effects_of, seq: str = "offset", at: str = "timestamp", crash=None,
                     block_rows: int = BLOCK_ROWS, fold_every: int = 8):
    """``foreachBatch`` function: ledger, effects and outbox of the new deliveries, together.

    ``effects_of(new_rows)`` gives the frames to write beside the ledger. The new rows are
    computed once and shared by the writes. The ledger is a set of offset ranges of which a
    batch reads a bounded number of files, so its cost follows the batch and not the age of
    the ledger. ``crash(stage)`` is a test hook.
    """
    ledger = IntervalLedger(store, block_rows, fold_every)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if store.is_committed(batch_id):
            return  # retried although its marker was written: leave readers undisturbed
        once = distinct_deliveries(batch, seq)
        fresh = ledger.fresh(once, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ledger.add(fresh.select(*DELIVERY, at), batch_id, at)
            for name, df in effects_of(fresh).items():
                store._write(df.select(*store.schemas[name].fieldNames()), name, batch_id)
            if crash:
                crash("before-marker")
            store.mark(batch_id)
            if crash:
                crash("after-marker")
        finally:
            fresh.unpersist()
    return apply
