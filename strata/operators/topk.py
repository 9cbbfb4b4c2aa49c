"""LIM-1 / TOPK-1 / SORT-1,2: ordering, first rows and top-k.

``top_k`` is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: each task keeps its own k best rows and only
k × tasks rows reach the final merge, whatever the table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(order):
    return [c if isinstance(c, Column) else F.col(c) for c in order]


def top_k(df: DataFrame, k: int, order) -> DataFrame:
    return df.orderBy(*_cols(order)).limit(k)


def first_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """LIM-1: a preview, ``df.limit(n)``."""
    return df.limit(n)


def sort_by(df: DataFrame, order) -> DataFrame:
    """SORT-1/2: a total order (range-partitioned sort)."""
    return df.orderBy(*_cols(order))
