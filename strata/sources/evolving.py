"""SRC-4, SRC-5: JSON lines whose fields grow over time (``addNewColumns``).

Lines are read as text. The schema in force is the last version of a log beside the
checkpoint. A micro-batch with fields that the schema lacks isn't written: the new
fields' types are inferred from the lines that have them, the schema with the new
columns at its end becomes the log's next version, and the stream starts again on it,
with that same batch. So no line loses a field, the types of known columns stay, and
only lines with new fields are ever inferred, the first batch's of a checkpoint first
of all. A value that doesn't fit its column is null and the whole line is kept in
``rescued``; files written before a column existed give null for it.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks import snapshots
from strata.streaming.metrics import batch_progress
from strata.streaming.runner import run_to_completion

RESCUED = "rescued"


class SchemaLog:
    """Versions of a schema, one folder each; a version is never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def last(self) -> tuple[int, T.StructType]:
        """(version, schema); version 0 has no columns."""
        try:
            row = self.spark.read.schema("value string").text(self.path).select("value", F.col("version").cast("int").alias("v")).orderBy(F.desc("v")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, T.StructType([])
        return row["v"], T.StructType.fromJson(json.loads(row["value"]))

    def add(self, version: int, schema: T.StructType) -> None:
        rows = self.spark.createDataFrame([(schema.json(),)], "value string")
        rows.coalesce(1).write.mode("errorifexists").text(f"{self.path}/version={version}")


class SchemaChanged(RuntimeError):
    pass


def new_fields(lines: DataFrame, schema: T.StructType):
    """A condition on ``value``: the line has fields that the schema lacks; and their names."""
    keys = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(f.name) for f in schema]).cast("array<string>"))
    return F.coalesce(F.size(keys) > 0, F.lit(False)), keys


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return lines.select(F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED}).alias("row")).select("row.*")


def run_evolving(spark: SparkSession, source: str, table: str, checkpoint: str, options: dict | None = None) -> dict:
    """One triggered run: all new files of ``source`` into the snapshot table ``table``.
    Returns rows and the number of schema changes; each change adds a column at least."""
    log, changes = SchemaLog(spark, checkpoint + ".schema"), 0
    before = snapshots.latest_version(spark, table)
    batch_progress(spark)
    while True:
        version, schema = log.last()

        def write(batch: DataFrame, batch_id: int, version=version, schema=schema) -> None:
            grown, keys = new_fields(batch, schema)
            lines = batch.filter(grown)
            if lines.limit(1).count():
                sample = f"{checkpoint}.grown/version={version + 1}"
                lines.select("value").write.mode("overwrite").text(sample, compression="gzip")
                known = {f.name for f in schema}
                inferred = spark.read.json(sample).schema
                log.add(version + 1, T.StructType([*schema.fields, *[f for f in inferred if f.name not in known]]))
                raise SchemaChanged(f"new columns in batch {batch_id}")
            snapshots.append_batch(parse_lines(batch, schema), table, batch_id)

        stream = spark.readStream.options(**(options or {})).text(source)
        query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
        try:
            run_to_completion(query)
        except RuntimeError:
            if log.last()[0] == version:
                raise
            changes += 1
            continue
        return {"rows": sum(p.rows for p in snapshots.added_since(spark, table, before)), "changes": changes}


def read_evolving(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """The table under the last schema."""
    schema = SchemaLog(spark, checkpoint + ".schema").last()[1]
    return snapshots.read(spark, table, T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())]))
