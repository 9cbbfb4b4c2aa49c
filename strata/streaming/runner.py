"""STR-1..6: incremental (triggered) runs of the bronze and silver streams.

Each run is ``trigger(availableNow=True)``: it processes every file that
arrived since the last run, in micro-batches capped by the configured rate
limit, then stops. Offsets and the dedup state live in checkpoints under the
shared folder, so a rerun after a failure resumes exactly where the last
committed batch ended. Bronze is a streaming file sink; silver is a snapshot
table (``sinks/snapshots.py``), whose versions are the ingest log of what reads
it. A full refresh is a new set of table and checkpoint locations
(``StreamLayout`` with a new root).

The number of a stream's state partitions is fixed when it starts.
``regrow_state`` moves it, while it is at rest, to a new checkpoint with more.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import PipelineConfig, parse_bytes
from strata.operators.dedup import FIRST_ARRIVAL
from strata.plans.features import silver_customer_activity
from strata.plans.orders import silver_orders
from strata.session import session_conf, shuffles_freed
from strata.sinks import snapshots
from strata.sinks.writers import write_stream
from strata.sources.readers import bronze_customer_activity, bronze_orders, read_table_stream
from strata.streaming.metrics import batch_progress, record_batches, without_gaps


@dataclass(frozen=True)
class StreamLayout:
    """Table and checkpoint locations of one pipeline instance."""
    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


#: Less than Spark needs for the 100 micro-batches whose progress it keeps.
POLL_SECONDS = 0.5


def run_to_completion(query, timeout_s: float | None = None) -> list[dict]:
    """Wait for an availableNow query; re-raise its failure; return its progress,
    one entry per micro-batch, from the session's listener. Of a query that was
    started before the listener Spark keeps the last 100 entries only, so they are
    gathered while it runs. A gap in the batch ids is an error.
    With ``timeout_s`` a query still running after that long is stopped and
    reported as a failure (its committed batches stay committed)."""
    batches: dict[int, dict] = {}
    deadline = None if timeout_s is None else time.monotonic() + timeout_s

    listener, run_id = batch_progress(SparkSession.getActiveSession()), str(query.runId)

    def gather():
        for p in query.recentProgress:
            if p["numInputRows"] or p["batchId"] not in batches:
                batches[p["batchId"]] = p
    try:
        while not query.awaitTermination(POLL_SECONDS):
            gather()
            if deadline is not None and time.monotonic() > deadline:
                query.stop()
                raise TimeoutError(f"Streaming query {query.name or query.id} still running after {timeout_s}s")
        gather()
    except StreamingQueryException as e:
        raise RuntimeError(f"Streaming query {query.name or query.id} failed: {e}") from e
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"Streaming query {query.name or query.id} failed: {exc}")
    if listener.knows(run_id):
        return listener.take(run_id)
    return without_gaps([batches[k] for k in sorted(batches)])


def observed_totals(progress: list[dict], name: str) -> dict[str, int]:
    """Sum one named observation over all micro-batches (DQ-4 for streams)."""
    totals: dict[str, int] = {}
    for p in progress:
        row = (p.get("observedMetrics") or {}).get(name)
        if not row:
            continue
        for k, v in (row if isinstance(row, dict) else row.asDict()).items():
            totals[k] = totals.get(k, 0) + int(v or 0)
    return totals


@dataclass(frozen=True)
class SilverStream:
    """What a silver stream is made of; ``keys`` are those of its dedup."""
    entity: str
    bronze: Callable[[SparkSession, PipelineConfig, str], DataFrame]
    silver: Callable[[DataFrame, PipelineConfig, str], tuple]
    date_col: str
    keys: tuple[str, ...]


ORDERS = SilverStream("orders", bronze_orders, silver_orders, "order_date", ("order_id", "product_id"))
ACTIVITY = SilverStream("customer_activity", bronze_customer_activity, silver_customer_activity, "activity_date", ("customer_id", "session_id"))


def _checkpoint(layout: StreamLayout, stream: SilverStream, generation: int) -> str:
    return layout.checkpoint(f"silver_{stream.entity}" + (f".g{generation}" if generation else ""))


def _upstream(spark: SparkSession, cfg: PipelineConfig, layout: StreamLayout, stream: SilverStream, generation: int) -> DataFrame:
    """Bronze as a stream and, from the second checkpoint on, the keys that seeded its state."""
    # Silver is limited by bytes: bronze files differ in size and may be small.
    limit = {"maxBytesPerTrigger": str(parse_bytes(cfg.max_bytes_per_trigger))}
    bronze = read_table_stream(spark, layout.table(f"bronze_{stream.entity}"), limit)
    if not generation:
        return bronze
    seed = read_table_stream(spark, _checkpoint(layout, stream, generation) + ".seed", limit)
    return bronze.unionByName(seed, allowMissingColumns=True)


#: Dedup state on disk instead of the executors' heaps, and the MB of memory that all
#: partitions' stores of an executor share. A checkpoint goes on with the store it began with.
_STORE = "spark.sql.streaming.stateStore."
STATE_ON_DISK = {_STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                 _STORE + "rocksdb.boundedMemoryUsage": "true", _STORE + "rocksdb.maxMemoryUsageMB": "256",
                 _STORE + "rocksdb.compression": "zstd", _STORE + "rocksdb.allowFAllocate": "false",  # no disk ahead of use, 4 MB and more a partition
                 _STORE + "rocksdb.trackTotalNumberOfRows": "false"}  # a second read for each key written


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in stores on disk, of bounded memory, unless
    the session names another kind of store; shuffle files go after each micro-batch."""
    provider = spark.conf.get(_STORE + "providerClass")
    own = {} if not provider.endswith((".HDFSBackedStateStoreProvider", ".RocksDBStateStoreProvider")) else {
        k: v for k, v in STATE_ON_DISK.items() if k.endswith("providerClass") or spark.conf.get(k, None) is None}
    with session_conf(spark, own), shuffles_freed(spark):
        yield


def _increment(spark: SparkSession, cfg: PipelineConfig, source_path: str, layout: StreamLayout, stream: SilverStream, dedup_mode: str) -> dict:
    batch_progress(spark)
    bronze_q = write_stream(stream.bronze(spark, cfg, source_path), layout.table(f"bronze_{stream.entity}"),
                            layout.checkpoint(f"bronze_{stream.entity}"))
    bronze_progress = run_to_completion(bronze_q)
    table = layout.table(f"silver_{stream.entity}")
    generation = snapshots.last_writer(spark, table)
    silver_df, metrics_name = stream.silver(_upstream(spark, cfg, layout, stream, generation), cfg, dedup_mode)
    with state_on_disk(spark):
        silver_q = snapshots.write_stream_batches(silver_df, table, _checkpoint(layout, stream, generation), str(generation), [stream.date_col],
                                                  stream.date_col, cfg.stream_write_fanout, stream.keys)
    silver_progress = run_to_completion(silver_q)
    if metrics_name:
        record_batches(spark, layout.table("_dq_batches"), silver_progress, metrics_name.removeprefix("dq_"), str(generation))
    return {
        "bronze_rows": sum(p.get("numInputRows", 0) for p in bronze_progress),
        "silver_input_rows": sum(p.get("numInputRows", 0) for p in silver_progress),
        "batches": len(silver_progress),
        "expectations": observed_totals(silver_progress, metrics_name) if metrics_name else {},
    }


def regrow_state(spark: SparkSession, cfg: PipelineConfig, layout: StreamLayout, stream: SilverStream, partitions: int,
                 dedup_mode: str = FIRST_ARRIVAL) -> int:
    """STR-2: move a silver stream that is at rest to a checkpoint whose dedup state has
    ``partitions`` partitions. Returns the number of its generation.

    The keys of the old state are read with Spark's state reader and written as a table.
    A new query reads them and bronze, with the new number of partitions, and discards
    what it puts out: afterwards its state holds every key seen, those of bronze files that
    retention has removed included, and its source log every bronze file. Then the table
    is marked as written by the new generation, from which moment on increments use the
    new checkpoint; a failure before leaves the old one in force.
    """
    table = layout.table(f"silver_{stream.entity}")
    generation = snapshots.last_writer(spark, table) + 1
    state = spark.read.format("statestore").load(_checkpoint(layout, stream, generation - 1))
    checkpoint = _checkpoint(layout, stream, generation)
    state.select(*[F.col(f"key.{k}").alias(k) for k in stream.keys]).write.mode("overwrite").parquet(checkpoint + ".seed")
    silver_df, _ = stream.silver(_upstream(spark, cfg, layout, stream, generation), cfg, dedup_mode)

    def discard(batch: DataFrame, _: int) -> None:
        batch.write.format("noop").mode("overwrite").save()

    with state_on_disk(spark), session_conf(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        # Only keys go into the state, so other columns that nothing checks needn't reach it.
        run_to_completion(silver_df.select(*stream.keys).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(discard)
                          .trigger(availableNow=True).start())
    snapshots.mark_writer(spark, table, str(generation))
    return generation


def state_partitions(spark: SparkSession, layout: StreamLayout, stream: SilverStream) -> int:
    """Partitions of the dedup state in force."""
    generation = snapshots.last_writer(spark, layout.table(f"silver_{stream.entity}"))
    return spark.read.format("state-metadata").load(_checkpoint(layout, stream, generation)).first()["numPartitions"]


def run_orders_increment(spark: SparkSession, cfg: PipelineConfig, source_path: str,
                         layout: StreamLayout, dedup_mode: str = FIRST_ARRIVAL) -> dict:
    """DS-1 -> DS-2 for every new JSON file under ``source_path`` (STR-4, STR-6)."""
    return _increment(spark, cfg, source_path, layout, ORDERS, dedup_mode)


def run_activity_increment(spark: SparkSession, cfg: PipelineConfig, source_path: str,
                           layout: StreamLayout, dedup_mode: str = FIRST_ARRIVAL) -> dict:
    """DS-8 -> DS-9 for every new JSON file under ``source_path``."""
    return _increment(spark, cfg, source_path, layout, ACTIVITY, dedup_mode)
