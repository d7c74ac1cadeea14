"""A table that grows, read as a stream: the offset of the stream is the high-water mark of a column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logtide.streaming.commits import CommitStore


class Polling:
    """Polls of ``read()`` by ``cursor``, each a batch: rows from the last mark up to the highest cursor there is then.

    The mark to reach is written before any row is read, so a retried poll reads the same range, whatever was inserted
    meanwhile. Rows that come later with a cursor equal to the mark are found by ``key``, which tells rows of one cursor
    value apart: the next poll starts at the mark and leaves out the keys it has already delivered there. Rows without a
    cursor are never read, as no mark passes them; rows below the mark that come late are what a cursor cannot see.

    Each poll reads the mark and the keys of the poll before it by path, so its cost does not grow with the polls made.
    ``read`` gives the table as it is now: Parquet, JDBC, or any other; the cursor condition reaches its scan.
    """

    def __init__(self, spark: SparkSession, root: str, read: Callable[[], DataFrame], cursor: str, key: str, crash=None):
        self.spark, self.read, self.cursor, self.key, self.crash = spark, read, cursor, key, crash
        self.schema = read().schema
        mark = T.StructType([T.StructField("mark", self.schema[cursor].dataType)])
        edge = T.StructType([T.StructField("key", self.schema[key].dataType)])
        self.store = CommitStore(spark, root, {"rows": self.schema, "marks": mark, "goals": mark, "edge": edge})

    def _mark(self, name: str, poll: int):
        row = self.store.of_batches(name, [poll]).first()
        return None if row is None else row.mark

    def _put_mark(self, name: str, poll: int, value) -> None:
        self.store._write(self.spark.createDataFrame([(value,)], self.store.schemas[name]).coalesce(1), name, poll)

    def poll(self, batch: DataFrame | None, poll: int) -> None:
        """``foreachBatch`` function over any stream that sets the pace; polls are numbered from 0 without gaps."""
        if self.store.is_committed(poll):
            return
        last = self._mark("marks", poll - 1)
        goal = self._mark("goals", poll)
        if goal is None:
            goal = self.read().agg(F.max(self.cursor)).first()[0]
            goal = last if goal is None or (last is not None and goal < last) else goal
            self._put_mark("goals", poll, goal)
        at = F.col(self.cursor)
        rows = self.read().select(*self.schema.fieldNames()).where(at <= F.lit(goal).cast(self.schema[self.cursor].dataType))
        known = self.store.of_batches("edge", [poll - 1]).select(F.col("key").alias(self.key))
        if last is not None:
            same = rows.where(at == F.lit(last)).join(known, self.key, "left_anti").select(*self.schema.fieldNames())
            rows = rows.where(at > F.lit(last)).unionByName(same)
        self.store._write(rows, "rows", poll)
        edge = self.store.of_batches("rows", [poll]).where(at == F.lit(goal)).select(F.col(self.key).alias("key"))
        if last is not None and goal == last:
            edge = edge.unionByName(known.select(F.col(self.key).alias("key")))
        self.store._write(edge, "edge", poll)
        self._put_mark("marks", poll, goal)
        if self.crash:
            self.crash("before-marker")
        self.store.mark(poll)

    def rows(self) -> DataFrame:
        """All rows delivered by committed polls, with their ``batch_id``."""
        return self.store.committed("rows")


def clock(spark: SparkSession) -> DataFrame:
    """A stream that has a batch whenever its trigger fires, to pace polls."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()
