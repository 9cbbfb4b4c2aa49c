"""AGG-11 / STR-2: deduplication by business key.

Batch: ``dedup_by_key`` keeps, per key, the row that is smallest under a given
column order (NULLs first), so results are repeatable. It is an aggregate,
``min(struct(order..., rest...))`` grouped by the key: Spark runs a partial
aggregate in every map task before the shuffle, so a key that holds a third of
all rows is collapsed to one row per task before it crosses the network — no
single task ever receives the hot key's rows. NULL keys form one group, as in
``dropDuplicates``.

Stream: ``dropDuplicates`` (keep first arrival; state grows with distinct keys
unless the watermark column is a key) or ``dropDuplicatesWithinWatermark``
(state bounded by the watermark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_ARRIVAL = "first"          # parity: dropDuplicates, unbounded state
WITHIN_WATERMARK = "watermark"   # bounded: dropDuplicatesWithinWatermark
ORDERED = "ordered"              # batch, repeatable choice
VALID_FIRST = "valid_first"      # the first valid row of a key


def dedup_by_key(df: DataFrame, keys, order_by=(), valid: Column | None = None) -> DataFrame:
    """One row per key. With ``valid`` a key's first valid row is kept, however a bad
    one is ordered, and a bad one only where the key has no other."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not rest:
        return df.select(*keys).distinct()
    first = [] if valid is None else [(~F.coalesce(valid, F.lit(False))).alias("_bad")]
    pick = F.min(F.struct(*first, *[F.col(c) for c in ordered])).alias("_row")
    out = df.groupBy(*keys).agg(pick)
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup(df: DataFrame, keys, mode: str = ORDERED, order_by=(), valid: Column | None = None) -> DataFrame:
    keys = list(keys)
    if mode == VALID_FIRST:
        if valid is None:
            raise ValueError(f"mode {VALID_FIRST!r} needs the condition of a valid row")
        # A stream keeps the first arrival, so only valid rows may arrive.
        return df.filter(F.coalesce(valid, F.lit(False))).dropDuplicates(keys) if df.isStreaming else dedup_by_key(df, keys, order_by, valid)
    if mode == ORDERED and not df.isStreaming:
        return dedup_by_key(df, keys, order_by)
    if mode == WITHIN_WATERMARK:
        return df.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)
