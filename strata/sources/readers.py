"""SRC-1..5, 7..10: batch and streaming readers with audit columns.

The same bronze function serves batch and stream: it takes a reader
(``spark.read`` or ``spark.readStream``) and adds the ingestion timestamp and
the source-file lineage column from the hidden ``_metadata`` struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import PipelineConfig
from strata.sources.schemas import ACTIVITY_SCHEMA, ORDERS_SCHEMA, PROFILE_SCHEMA


def with_audit(df: DataFrame, lineage: bool = True) -> DataFrame:
    """SRC-7 ingestion_timestamp, SRC-8 source_file (from ``_metadata.file_path``)."""
    df = df.withColumn("ingestion_timestamp", F.current_timestamp())
    if lineage:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              stream: bool = False, options: dict | None = None) -> DataFrame:
    """Read JSON lines, batch or stream. Without a schema the batch reader
    infers one; a stream gets the schema inferred once from a batch read (SRC-5)."""
    if stream:
        if schema is None:
            schema = spark.read.json(path).schema
        reader = spark.readStream.format("json").schema(schema)
    else:
        reader = spark.read.format("json")
        if schema is not None:
            reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path)


def bronze_orders(spark: SparkSession, cfg: PipelineConfig, path: str | None = None,
                  stream: bool = True) -> DataFrame:
    """DS-1 / SRC-1: typed JSON orders with audit columns."""
    opts = cfg.streaming_options() if stream else None
    df = read_json(spark, path or cfg.orders_source_path, ORDERS_SCHEMA, stream, opts)
    return with_audit(df)


def bronze_customer_activity(spark: SparkSession, cfg: PipelineConfig, path: str | None = None,
                             stream: bool = True) -> DataFrame:
    """DS-8 / SRC-2."""
    opts = cfg.streaming_options() if stream else None
    df = read_json(spark, path or cfg.activity_source_path, ACTIVITY_SCHEMA, stream, opts)
    return with_audit(df)


def bronze_customer_profiles(spark: SparkSession, cfg: PipelineConfig,
                             path: str | None = None) -> DataFrame:
    """DS-10 / SRC-3: batch, no lineage column."""
    df = read_json(spark, path or cfg.profiles_source_path, PROFILE_SCHEMA, stream=False)
    return with_audit(df, lineage=False)


def sample_bronze_orders(spark: SparkSession, path: str, stream: bool = True,
                         options: dict | None = None) -> DataFrame:
    """DS-15 / SRC-5: orders with an inferred schema."""
    return read_json(spark, path, None, stream, options)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: an upstream table read whole."""
    return spark.read.parquet(path)


def read_table_stream(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """SRC-9: an upstream table read incrementally (schema taken from the table)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if options:
        r = r.options(**options)
    return r.parquet(path)
