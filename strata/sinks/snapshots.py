"""SNK-3/4, STR-6: tables that grow batch by batch, read through published snapshots.

Each batch is written to a folder of its own (``<table>/batch=<name>``), so a batch
that is run again overwrites its own files and nothing else. A snapshot is a list of
*pieces*, one row each: a batch, or what a compaction made of several. It is published
as one new folder ``_snapshots/version=<n>``; a version is never changed. Readers take
the latest version, so they see whole batches only, before and after a compaction.

A snapshot is also the ingest log: each piece has the version that added it, its rows
and the months it touches. A consumer that remembers a version reads just the batches
added since, and needs no clock and no scan of older files. A table has one writer.

The pieces of a snapshot are few (batches since the last compaction, and compacted
ones), so they are handled on the driver; rows never are.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks.writers import cluster_columns, clustered, stream_clustered

BATCH, COMPACTED, MARK = "batch", "compacted", "mark"


@dataclass(frozen=True)
class Piece:
    """A folder of rows. A compacted range of dates leaves a batch with later dates only
    (``date_col`` beyond ``after``, an ISO date). A mark has no rows: it holds the last batch id of a writer."""

    name: str
    kind: str = BATCH
    added: int = 0
    after: str | None = None
    date_col: str | None = None
    rows: int = 0
    months: tuple[str, ...] = ()
    last_id: int = -1


_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("added", T.LongType()),
    T.StructField("after", T.StringType()), T.StructField("date_col", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("months", T.ArrayType(T.StringType())),
    T.StructField("last_id", T.LongType())])


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SCHEMA).json(f"{path}/_snapshots").withColumn("version", F.col("version").cast("long"))
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN.WITH_SUGGESTION"):
            return None
        raise


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the last snapshot, 0 where there is none."""
    versions = _versions(spark, path)
    return 0 if versions is None else versions.agg(F.max("version")).first()[0] or 0


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[Piece]]:
    """(version, pieces) of the given or the last snapshot."""
    versions = _versions(spark, path)
    if versions is None:
        return 0, []
    version = latest_version(spark, path) if version is None else version
    rows = versions.filter(F.col("version") == version).drop("version").collect()
    return version, [Piece(**{**r.asDict(), "months": tuple(r["months"] or ())}) for r in rows]


def is_snapshot_table(spark: SparkSession, path: str) -> bool:
    return _versions(spark, path) is not None


def _publish(spark: SparkSession, path: str, version: int, pieces: list[Piece]) -> int:
    """Make ``pieces`` the snapshot ``version``; an error if that version exists."""
    rows = spark.createDataFrame([tuple(asdict(p)[f.name] for f in _SCHEMA) for p in pieces], _SCHEMA)
    rows.coalesce(1).write.mode("errorifexists").json(f"{path}/_snapshots/version={version}")
    return version


def _counted(df: DataFrame, date_col: str | None) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of the rows and months that a write of it sees, so
    that the written folder needn't be listed and read again."""
    seen = Observation()
    months = [] if date_col is None else [F.collect_set(F.date_format(date_col, "yyyy-MM")).alias("months")]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *months), seen


def _write(df: DataFrame, path: str, name: str, partition_cols=(), max_records: int | None = None) -> str:
    folder = f"{path}/batch={name}"
    w = df.write.mode("overwrite").partitionBy(*partition_cols) if partition_cols else df.write.mode("overwrite")
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(folder)
    return folder


def _contents(spark: SparkSession, folder: str, schema: T.StructType, date_col: str | None) -> tuple[int, tuple[str, ...]]:
    """Rows and months of a written folder; reads the partition column only."""
    df = spark.read.schema(schema).parquet(folder)
    if date_col is None:
        return df.count(), ()
    month = F.date_format(date_col, "yyyy-MM").alias("month")
    found = df.groupBy(month).count().collect()
    return sum(r["count"] for r in found), tuple(sorted(r["month"] for r in found if r["month"]))


def _batch_name(writer: str, batch_id: int) -> str:
    return f"{writer}-{batch_id:08d}"


def stage_batch(df: DataFrame, path: str, batch_id: int, writer: str = "0", partition_cols=(), more: bool = False) -> DataFrame:
    """Write a batch, or (``more``) a further part of it, that ``append_batch(..., staged=True)``
    publishes when it is whole; returns what it has so far."""
    folder = f"{path}/batch={_batch_name(writer, batch_id)}"
    df.write.mode("append" if more else "overwrite").partitionBy(*partition_cols).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def append_batch(df: DataFrame, path: str, batch_id: int, writer: str = "0", partition_cols=(), date_col: str | None = None,
                 max_records: int | None = None, staged: bool = False) -> int:
    """Add a batch; returns the version. A batch that was published before isn't added
    again, but it is run, as the state of a stream advances with it. With ``staged``
    the rows are those that ``stage_batch`` has returned and are published as they are."""
    spark = df.sparkSession
    version, pieces = snapshot(spark, path)
    mark = next((p for p in pieces if p.kind == MARK and p.name == writer), Piece(writer, MARK))
    if batch_id <= mark.last_id:
        if staged:
            return version
        df.write.format("noop").mode("overwrite").save()
        return version
    name = _batch_name(writer, batch_id)
    if staged:
        rows, months = _contents(spark, f"{path}/batch={name}", df.schema, date_col)
    else:
        df, seen = _counted(df, date_col)
        _write(df, path, name, partition_cols, max_records)
        rows, months = seen.get["rows"], tuple(sorted(seen.get.get("months") or ()))
    pieces = [p for p in pieces if p is not mark and p != mark] + [replace(mark, last_id=batch_id)]
    if rows:
        pieces.append(Piece(name, BATCH, version + 1, rows=rows, months=months))
    return _publish(spark, path, version + 1, pieces)


def write_stream_batches(df: DataFrame, path: str, checkpoint: str, writer: str = "0", partition_cols=(), date_col: str | None = None,
                         fanout: int = 4, salt_cols=()):
    """Start a triggered stream whose micro-batches are appended to a snapshot table."""
    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id, writer, partition_cols, date_col)

    return (stream_clustered(df, partition_cols, fanout, salt_cols).writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint).foreachBatch(append).trigger(availableNow=True).start())


def mark_writer(spark: SparkSession, path: str, writer: str) -> int:
    """Publish that ``writer`` goes on with the table."""
    version, pieces = snapshot(spark, path)
    return _publish(spark, path, version + 1, [*pieces, Piece(writer, MARK)])


def last_writer(spark: SparkSession, path: str) -> int:
    """The number of the writer that the table has now; writers count up from 0."""
    return max((int(p.name) for p in snapshot(spark, path)[1] if p.kind == MARK), default=0)


def _read(spark: SparkSession, path: str, pieces: list[Piece], schema: T.StructType | None) -> DataFrame:
    groups: dict[tuple, list[str]] = {}
    for p in pieces:
        groups.setdefault((p.after, p.date_col), []).append(f"{path}/batch={p.name}")
    parts = []
    for (after, date_col), folders in groups.items():
        reader = spark.read.option("basePath", path)
        df = (reader.schema(schema) if schema is not None else reader).parquet(*folders)
        if after is not None:  # a filter on the partition column: earlier dates' folders aren't read
            df = df.filter((F.col(date_col) > F.lit(after).cast("date")) | F.col(date_col).isNull())
        parts.append(df.drop("batch"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """The rows of the given or the last snapshot."""
    pieces = [p for p in snapshot(spark, path, version)[1] if p.kind != MARK]
    if not pieces:
        if schema is None:
            raise ValueError(f"{path} has no rows yet; give its schema")
        return spark.createDataFrame([], schema)
    return _read(spark, path, pieces, schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table's rows: the last snapshot where it has snapshots, else all its files."""
    return read(spark, path) if is_snapshot_table(spark, path) else spark.read.parquet(path)


def added_since(spark: SparkSession, path: str, version: int) -> list[Piece]:
    """Batches added after a version, as they were added, compacted since or not."""
    versions = _versions(spark, path)
    if versions is None:
        return []
    rows = versions.filter((F.col("version") > version) & (F.col("kind") == BATCH) & (F.col("added") == F.col("version"))).drop("version").collect()
    return sorted((Piece(**{**r.asDict(), "months": tuple(r["months"] or ())}) for r in rows), key=lambda p: p.added)


def read_pieces(spark: SparkSession, path: str, pieces: list[Piece], schema: T.StructType | None = None) -> DataFrame:
    """The rows of given batches; only their files are listed and read."""
    return _read(spark, path, [replace(p, after=None) for p in pieces], schema)


#: Compacted pieces above which a compaction takes them in again, so that the files of a date stay few.
MOST_COMPACTED = 8


def compact_dates(spark: SparkSession, path: str, through: str, date_col: str, cluster_cols=(), max_records: int | None = None,
                  most_compacted: int = MOST_COMPACTED) -> int:
    """Bin-pack the rows dated up to ``through`` (ISO) of all batches: one folder, rebalanced
    by date (AQE joins small dates' rows in tasks and splits large dates), sorted on the
    clustering columns. Batches keep later and undated rows. Folders that the new snapshot
    no longer reads stay for readers of older ones. Returns the version."""
    version, pieces = snapshot(spark, path)
    packed = [p for p in pieces if p.kind == COMPACTED]
    open_pieces = [p for p in pieces if p.kind == BATCH and (p.after is None or p.after < through)]
    if not open_pieces:
        return version
    taken = open_pieces + (packed if len(packed) >= most_compacted else [])
    day, last_day = F.col(date_col), F.lit(through).cast("date")
    closed = _read(spark, path, taken, None).filter(day <= last_day)
    name = f"c-{version + 1:08d}"
    cluster_columns(closed, cluster_cols)
    folder = _write(clustered(closed, cluster_cols, [date_col]), path, name, [date_col], max_records)
    rows, months = _contents(spark, folder, closed.schema, date_col)
    folders = [f"{path}/batch={p.name}" for p in open_pieces]
    later = spark.read.option("basePath", path).parquet(*folders).filter((day > last_day) | day.isNull()).select("batch").distinct().collect()
    later = {r["batch"] for r in later}
    kept = [p for p in pieces if p not in taken] + [replace(p, after=through, date_col=date_col) for p in open_pieces if p.name in later]
    return _publish(spark, path, version + 1, kept + ([Piece(name, COMPACTED, version + 1, rows=rows, months=months)] if rows else []))


def rewrite(df: DataFrame, path: str, partition_cols=(), cluster_cols=(), parts=()) -> int:
    """Publish ``df`` as the whole table (such as merged partial sums); marks stay. With
    ``parts``, conditions of which each row meets one, a part is written after the other."""
    spark = df.sparkSession
    version, pieces = snapshot(spark, path)
    name = f"c-{version + 1:08d}"
    folder = f"{path}/batch={name}"
    for i, part in enumerate(parts or [F.lit(True)]):
        some = df.filter(part)
        if partition_cols:
            some = clustered(some, cluster_cols, partition_cols)
        some.write.mode("append" if i else "overwrite").partitionBy(*partition_cols).parquet(folder)
    rows, _ = _contents(spark, folder, df.schema, None)
    return _publish(spark, path, version + 1, [p for p in pieces if p.kind == MARK] + [Piece(name, COMPACTED, version + 1, rows=rows)])
