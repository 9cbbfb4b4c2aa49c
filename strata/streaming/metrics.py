"""DQ-4 for streams: the expectation metrics of every micro-batch, from a listener.

A query keeps the progress of its last 100 micro-batches only. The listener gets each
batch's progress as Spark posts it, however long the driver is busy elsewhere, and the
end of a query comes after all its batches. A run's batch ids must follow each other
without a gap, or the run is reported as failed.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_LISTENERS: dict[str, "BatchProgress"] = {}


class BatchProgress(StreamingQueryListener):
    """Progress by run and batch: ``{"batchId", "numInputRows", "observedMetrics"}``."""

    def __init__(self):
        self._lock = threading.Lock()
        self._runs: dict[str, tuple[dict[int, dict], threading.Event]] = {}

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs[str(event.runId)] = ({}, threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            run = self._runs.get(str(p.runId))
            # A query without new data repeats its last batch's id with no rows.
            if run is not None and (p.numInputRows or p.batchId not in run[0]):
                run[0][p.batchId] = {"batchId": p.batchId, "numInputRows": p.numInputRows,
                                     "observedMetrics": {k: v.asDict() for k, v in p.observedMetrics.items()}}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            run = self._runs.get(str(event.runId))
        if run is not None:
            run[1].set()

    def knows(self, run_id: str) -> bool:
        with self._lock:
            return run_id in self._runs

    def take(self, run_id: str, timeout_s: float = 60) -> list[dict]:
        """All batches of a run that has ended, in order; forgets the run."""
        batches, ended = self._runs[run_id]
        if not ended.wait(timeout_s):
            raise RuntimeError(f"No end of streaming run {run_id} was reported within {timeout_s}s")
        with self._lock:
            del self._runs[run_id]
        return without_gaps([batches[k] for k in sorted(batches)])


def without_gaps(progress: list[dict]) -> list[dict]:
    """``progress`` of one run, if its batch ids follow each other."""
    ids = [p["batchId"] for p in progress]
    if ids and ids != list(range(ids[0], ids[0] + len(ids))):
        raise RuntimeError(f"Progress of micro-batches is missing: {sorted(set(range(ids[0], ids[-1])) - set(ids))}")
    return progress


def batch_progress(spark: SparkSession) -> BatchProgress:
    """The session's listener; registered at the first call, before a query starts."""
    key = spark.sparkContext.applicationId
    if key not in _LISTENERS:
        _LISTENERS[key] = BatchProgress()
        spark.streams.addListener(_LISTENERS[key])
    return _LISTENERS[key]


_SCHEMA = ("dataset string, writer string, batch_id long, expectation string, total_records long, failed_records long, passed_records long")


def record_batches(spark: SparkSession, path: str, progress: list[dict], dataset: str, writer: str = "0") -> int:
    """Write one row per micro-batch and expectation of ``dataset``; a batch that is run
    again replaces its rows. Returns the number of batches. The rows are a few counters
    a batch, built on the driver."""
    rows = []
    for p in progress:
        found = p["observedMetrics"].get(f"dq_{dataset}")
        if found is None:
            continue
        found = found if isinstance(found, dict) else found.asDict()
        total = int(found["total_records"] or 0)
        rows += [(dataset, writer, p["batchId"], k.removeprefix("failed_"), total, int(v or 0), total - int(v or 0))
                 for k, v in found.items() if k.startswith("failed_")]
    if rows:
        (spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dataset", "writer", "batch_id").parquet(path))
    return len({r[2] for r in rows})


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`record_batches`."""
    return spark.read.schema(_SCHEMA).parquet(path)


def missing_batches(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, writer, after_batch, missing): gaps in the recorded batch ids, such as
    after a driver that was lost between a commit and its record."""
    ids = batch_metrics(spark, path).select("dataset", "writer", "batch_id").distinct()
    following = ids.select("dataset", "writer", (F.col("batch_id") - 1).alias("batch_id"), F.lit(True).alias("follows"))
    last = ids.groupBy("dataset", "writer").agg(F.max("batch_id").alias("last"))
    ends = ids.join(following, ["dataset", "writer", "batch_id"], "left").filter("follows IS NULL").join(last, ["dataset", "writer"]).filter("batch_id < last")
    starts = ids.select("dataset", "writer", F.col("batch_id").alias("next"))
    return (ends.join(starts, ["dataset", "writer"]).filter("next > batch_id").groupBy("dataset", "writer", F.col("batch_id").alias("after_batch"))
            .agg((F.min("next") - F.col("after_batch") - 1).alias("missing")))
