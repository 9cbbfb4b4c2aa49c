"""SET-1 / AGG-10: union by name and distinct rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames, allow_missing: bool = True) -> DataFrame:
    """Union of frames matched by column name; a column missing from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows of a projection (partial aggregation per task before the shuffle)."""
    return df.select(*cols).distinct()
