"""Query progress as metric samples, in the shape the counter and alert operators read."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQueryListener

from logtide.session import scratch_path

SAMPLES = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())), T.StructField("value", T.DoubleType()),
])


class ProgressMetrics(StreamingQueryListener):
    """Writes a few samples per micro-batch to a table in the shared folder; ``drain`` hands them over and forgets them.

    The driver holds the samples of less than ``events`` progress events, and writes them when it has as many, when a query
    ends and at a drain. If a write fails, its samples stay for the next one, so none is lost while the driver lives. The
    files of a drained table stay until the folder's own retention removes them.
    """

    def __init__(self, events: int = 8):
        self._events, self._held, self._rows, self._folder = events, 0, [], None
        self._lock = threading.RLock()

    def _flush(self) -> None:
        """One file of JSON lines, under its name only when it is whole."""
        if not self._rows:
            return
        spark = SparkSession._getActiveSessionOrCreate()
        folder = self._folder or scratch_path(spark, "progress")
        path = spark._jvm.org.apache.hadoop.fs.Path
        name = uuid.uuid4().hex
        part, whole = path(f"{folder}/_{name}"), path(f"{folder}/{name}.json")
        files = part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out = files.create(part)
        try:
            out.write(bytearray("".join(json.dumps(r) + "\n" for r in self._rows), "utf-8"))
        finally:
            out.close()
        if not files.rename(part, whole):
            raise OSError(f"cannot rename to {whole.toString()}")
        self._folder, self._rows, self._held = folder, [], 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._flush()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        labels = {"query": p.name or str(p.id), "run": str(p.runId)}
        values = {
            "batch_id": p.batchId, "input_rows": p.numInputRows,
            "input_rows_per_second": p.inputRowsPerSecond, "processed_rows_per_second": p.processedRowsPerSecond,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "late_rows_dropped": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        }
        with self._lock:
            for name, value in values.items():
                self._rows.append({"ts": p.timestamp, "name": f"stream_{name}", "labels": labels, "value": float(value or 0.0)})
            self._held += 1
            if self._held >= self._events:
                self._flush()

    def drain(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            self._flush()
            folder, self._folder = self._folder, None
        samples = spark.read.schema(SAMPLES).json(folder) if folder else spark.createDataFrame([], SAMPLES)
        return samples.selectExpr("CAST(ts AS TIMESTAMP) AS ts", "name", "labels", "value")
