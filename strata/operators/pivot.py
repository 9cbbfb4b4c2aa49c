"""AGG-9: per-key counts pivoted over a fixed value list.

``pivot_counts`` is the two-level form (count per (key, value), then
``pivot(values).agg(first)`` and zero-fill): two shuffles. ``conditional_counts``
gives the same table with one aggregate of ``count_if`` per listed value, which
also fuses with other per-key aggregates; it is what the feature tables use.
Unlisted and NULL values are not counted, but their keys stay with zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, key: str, pivot_col: str, values, suffix: str = "") -> DataFrame:
    values = list(values)
    per_value = df.groupBy(key, pivot_col).agg(F.count(F.lit(1)).alias("_n"))
    wide = (per_value.groupBy(key).pivot(pivot_col, values).agg(F.first("_n"))
            .fillna(0, subset=values))
    return wide.withColumnsRenamed({v: f"{v}{suffix}" for v in values}) if suffix else wide


def conditional_count_columns(pivot_col: str, values, suffix: str = ""):
    return [F.count_if(F.col(pivot_col) == F.lit(v)).alias(f"{v}{suffix}") for v in values]


def conditional_counts(df: DataFrame, key: str, pivot_col: str, values, suffix: str = "") -> DataFrame:
    return df.groupBy(key).agg(*conditional_count_columns(pivot_col, values, suffix))
