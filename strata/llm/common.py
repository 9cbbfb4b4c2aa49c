"""Small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import new_work_path

#: Words of the contracts: runs of anything but the ASCII white space below.
SPACES = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    A column that a lambda refers to may be inlined by the optimizer and then
    be computed again for each element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder.

    It cuts the lineage: what has been written is read again, not computed
    again, when an executor is lost later.
    """
    path = new_work_path(df.sparkSession, label) + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows (of a few numbers each) up to which a table is broadcast.
BROADCAST_ROWS = 400_000


def broadcast_if_small(df: DataFrame, rows: Column | None = None) -> DataFrame:
    """A written table to be joined: broadcast if its rows (or the sum of
    ``rows`` over them) are few, else left to a shuffled join."""
    size = df.agg(F.sum(rows) if rows is not None else F.count(F.lit(1))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_ROWS else df
