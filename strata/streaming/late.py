"""STR-3: rows behind an event-time watermark are kept in a table of their own.

Spark's stateful operators drop such rows and count them at best. Here each micro-batch
is split before any of them: a batch's watermark is the largest event time of the
batches before it, less the delay, as Spark's own. The largest event time of each batch
is recorded by batch id, so a batch that is run again is split the same way.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks import snapshots
from strata.streaming.metrics import batch_progress
from strata.streaming.runner import run_to_completion


def _largest_before(spark: SparkSession, path: str, batch_id: int):
    try:
        return (spark.read.schema("largest timestamp").parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
                .filter(F.col("batch_id") < batch_id).agg(F.max("largest")).first()[0])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_with_late_rows(spark: SparkSession, stream: DataFrame, event_time: str, delay: str, table: str, late_table: str, checkpoint: str) -> dict:
    """One triggered run of ``stream``: rows at or after the watermark, or without event
    time, are appended to ``table``, the others to ``late_table``. Returns both counts."""
    batch_progress(spark)
    before = [snapshots.latest_version(spark, t) for t in (table, late_table)]

    def write(batch: DataFrame, batch_id: int) -> None:
        times = f"{checkpoint}.event_times"
        largest = _largest_before(spark, times, batch_id)
        batch.persist()
        try:
            late = F.lit(False) if largest is None else F.coalesce(F.col(event_time) < F.lit(largest) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            snapshots.append_batch(batch.filter(~late), table, batch_id)
            snapshots.append_batch(batch.filter(late), late_table, batch_id)
            batch.agg(F.max(event_time).alias("largest")).coalesce(1).write.mode("overwrite").parquet(f"{times}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    run_to_completion(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start())
    counts = [sum(p.rows for p in snapshots.added_since(spark, t, v)) for t, v in zip((table, late_table), before)]
    return {"on_time": counts[0], "late": counts[1]}
