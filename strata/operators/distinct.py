"""AGG-2 beside other aggregates: exact distinct counts without widened rows.

Several ``count_distinct`` in one aggregate repeat every row once per counted column,
and each copy holds the (empty) buffers of all other aggregates until the copies are
counted: a sketch alone takes hundreds of bytes a copy. Here the different values are
found in an aggregate that has no buffers, and only one row for each goes, with
the rows themselves, to the aggregate by group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KIND, _VALUE = "_kind", "_value"


def agg_with_distinct(df: DataFrame, keys, aggs: list[Column], distinct: dict[str, str]) -> DataFrame:
    """``df.groupBy(keys).agg(*aggs)`` and, for each ``{output: column}``, that column's
    exact distinct count. ``aggs`` must ignore NULLs (no ``count(*)``): the counted
    values join the groups as rows whose other columns are NULL."""
    kinds = {out: i for i, out in enumerate(distinct)}
    pairs = [F.struct(F.lit(kinds[out]).alias(_KIND), F.col(c).cast("string").alias(_VALUE)) for out, c in distinct.items()]
    values = df.select(*keys, F.inline(F.array(*pairs))).filter(F.col(_VALUE).isNotNull()).distinct()
    both = df.unionByName(values.drop(_VALUE), allowMissingColumns=True)
    return both.groupBy(*keys).agg(*aggs, *[F.count_if(F.col(_KIND) == i).alias(out) for out, i in kinds.items()])
