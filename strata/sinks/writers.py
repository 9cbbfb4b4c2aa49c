"""SNK-1..7: JSON hand-over, table writes with partitioning, clustering and file sizing.

Writes are idempotent overwrites of a directory (batch) or checkpointed
appends (stream), so a lost executor or a rerun of a failed job repeats the
same output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rough per-value widths: a row budget for a table that has no earlier commit to measure.
_WIDTH = {T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.DateType: 4,
          T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1, T.StringType: 24}


def estimated_row_bytes(schema: T.StructType) -> int:
    return max(1, sum(_WIDTH.get(type(f.dataType), 32) for f in schema.fields))


def records_per_file(df: DataFrame, target_file_size_bytes: int, row_bytes: float | None = None) -> int:
    """SNK-5: a ``maxRecordsPerFile`` budget for a target file size, from the measured
    width of a row on disk; without one from the types (Parquet is compressed, so that
    errs toward files under the target)."""
    return max(1000, int(target_file_size_bytes / (row_bytes or estimated_row_bytes(df.schema))))


#: Files of the last commit whose sizes and rows are read.
MEASURED_FILES = 64


def measured(spark, path: str, fmt: str = "parquet") -> tuple[float, float] | None:
    """SNK-5: (bytes a row, bytes in all) that the last commit of a table takes on disk.

    Up to ``MEASURED_FILES`` of its files, evenly spaced over the listing, are
    counted (Parquet: footers only) and stand for the others. None where there is
    no table yet, or no rows in it.
    """
    try:
        files = spark.read.format(fmt).load(path).inputFiles()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if not files:
        return None
    files = sorted(files)
    some = files[::-(-len(files) // MEASURED_FILES)]
    sizes = (spark.read.format(fmt).load(some).groupBy("_metadata.file_path", "_metadata.file_size").count()
             .agg(F.sum("file_size").alias("bytes"), F.sum("count").alias("rows")).first())
    return (sizes["bytes"] / sizes["rows"], sizes["bytes"] * len(files) / len(some)) if sizes["rows"] else None


def cluster_columns(df: DataFrame, cluster_cols, partition_cols=()) -> list[str]:
    """SNK-4 column list: partition columns are dropped (constant inside a
    partition directory); a column the table lacks is an error."""
    missing = [c for c in cluster_cols if c not in df.columns]
    if missing:
        raise ValueError(f"Clustering columns not in table: {missing}")
    return [c for c in cluster_cols if c not in set(partition_cols)]


def clustered(df: DataFrame, cluster_cols, partition_cols=(), num_partitions: int | None = None) -> DataFrame:
    """SNK-4 (and the optimized-write part of SNK-5) for a batch write.

    With partition columns: ``rebalance`` on them — a shuffle whose output AQE
    re-plans at runtime, splitting a partition value that holds a third of the
    rows over several tasks and merging small ones — so each partition
    directory gets few, evenly sized files instead of one file per input task.
    Rows are then sorted within each task on the clustering columns, giving
    narrow min/max ranges per file (Parquet row-group skipping).
    Without partition columns: range-partition on the clustering columns.
    """
    keys = cluster_columns(df, cluster_cols, partition_cols)
    if partition_cols:
        out = df.hint("rebalance", *partition_cols)
        return out.sortWithinPartitions(*partition_cols, *keys)
    if not keys:
        return df
    out = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def stream_clustered(df: DataFrame, partition_cols, fanout: int = 4, salt_cols=()) -> DataFrame:
    """Optimized write for a stream: each micro-batch is hash-partitioned on
    (partition columns, ``pmod(xxhash64(salt_cols), fanout)``). A partition
    value lands in at most ``fanout`` tasks — few files per directory and
    micro-batch — and a value holding a third of the batch is split over
    ``fanout`` tasks instead of one. One pass: no sampling job (a range
    partitioner would re-run the micro-batch, and with it the stateful dedup
    and the observed expectation metrics)."""
    if not partition_cols:
        return df
    cols = [F.col(c) for c in partition_cols]
    if fanout > 1:
        cols.append(F.pmod(F.xxhash64(*[F.col(c) for c in (salt_cols or df.columns)]), F.lit(fanout)))
    return df.repartition(*cols)


def write_table(df: DataFrame, path: str, partition_cols=(), cluster_cols=(),
                target_file_size_bytes: int | None = None, mode: str = "overwrite",
                fmt: str = "parquet", comment: str | None = None,
                properties: dict | None = None) -> str:
    """SNK-2/3/4/5: persist a dataset (with an optional comment and properties).

    A table that a stream appends to is not overwritten: that would delete the
    sink's log while the stream's checkpoint stays.

    With a target size, rows a file follow the width that rows of the last commit
    at ``path`` take on disk (:func:`measured`). An overwritten table without
    partition columns is also cut into as many ranges as the last commit fills
    files of that size; as ranges are never quite even, files may then exceed the
    target by a quarter, which spares a small rest beside each.
    """
    if mode == "overwrite" and is_stream_table(df.sparkSession, path):
        raise ValueError(f"{path} is written by a stream; use another root for batch runs")
    last = measured(df.sparkSession, path, fmt) if target_file_size_bytes else None
    ranges = max(1, round(last[1] / target_file_size_bytes)) if last and mode == "overwrite" and not partition_cols else None
    if cluster_cols or partition_cols:
        df = clustered(df, cluster_cols, partition_cols, ranges)
    w = df.write.mode(mode).format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if target_file_size_bytes:
        limit = target_file_size_bytes * (1.25 if ranges else 1)
        w = w.option("maxRecordsPerFile", records_per_file(df, limit, last and last[0]))
    w.save(path)
    if comment is not None or properties:
        write_table_info(df.sparkSession, path, comment, properties)
    return path


def is_stream_table(spark, path: str) -> bool:
    """Whether ``path`` has the log of a streaming sink or published batches (on any file system)."""
    for log in ("_spark_metadata", "_snapshots"):
        try:
            spark.read.text(f"{path}/{log}").schema
            return True
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return False


def write_table_info(spark, path: str, comment: str | None, properties: dict | None = None) -> None:
    """Table comment and properties as a one-row JSON sidecar in ``<path>/_table_info``
    (readers of the table skip ``_``-prefixed folders)."""
    import json as _json
    row = [(comment or "", _json.dumps(properties or {}, sort_keys=True))]
    (spark.createDataFrame(row, "comment string, properties string").coalesce(1)
     .write.mode("overwrite").json(f"{path}/_table_info"))


def table_info(spark, path: str) -> dict:
    """Read a table's comment and properties written by ``write_table``."""
    import json as _json
    r = spark.read.schema("comment string, properties string").json(f"{path}/_table_info").first()
    return {"comment": r["comment"], "properties": _json.loads(r["properties"])} if r else {}


#: Rows of a JSON file; orders of that many take about 50 MB.
JSON_ROWS = 250_000


def json_files(rows: int, least: int = 1) -> int:
    """Files for about that many rows: ``least`` of small data, more as it grows, so
    that what a task writes stays bounded."""
    return max(least, -(-rows // JSON_ROWS))


def write_json(df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> str:
    """SNK-1: JSON lines (NULL fields are left out of each line)."""
    if num_files:
        df = df.repartition(num_files)
    df.write.mode(mode).format("json").save(path)
    return path


def write_hand_over(df: DataFrame, path: str, rows: int, least: int = 1) -> int:
    """SNK-1 for what a stream reads: gzipped JSON lines in ``least`` files while about
    ``rows`` fit in them. Of more rows each task writes its own, a file for every
    ``JSON_ROWS``, so that no row crosses the network for the sake of file sizes.
    Returns the number of files."""
    few = json_files(rows, least) <= least
    w = (df.repartition(least) if few else df).write.mode("overwrite").option("compression", "gzip")
    (w if few else w.option("maxRecordsPerFile", JSON_ROWS)).json(path)
    return len(df.sparkSession.read.text(path).inputFiles())


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_cols=(),
                 fmt: str = "parquet", query_name: str | None = None, available_now: bool = True,
                 fanout: int = 4, salt_cols=()):
    """SNK-2/3 for a stream: checkpointed append into a file table."""
    df = stream_clustered(df, partition_cols, fanout, salt_cols)
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """SNK-7: the first rows of a table."""
    return df.limit(n)


def row_count(df: DataFrame) -> int:
    """SNK-7: the row count (one aggregate)."""
    return df.count()

