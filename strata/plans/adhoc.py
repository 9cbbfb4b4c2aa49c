"""SQL-1: ad-hoc SQL over the pipeline's tables.

Tables are exposed as temporary views (or read from their written location)
and queried with ``spark.sql``; Catalyst plans the SQL exactly like the
DataFrame code (``ORDER BY ... LIMIT k`` becomes a per-task top-k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sinks.snapshots import read_table


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """Expose written tables by name."""
    register_views(spark, {n: read_table(spark, p) for n, p in paths.items()})


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)
