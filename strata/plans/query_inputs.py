"""What the registered queries share: run dates, configuration, raw inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.functions.dates import parse_date
from strata.operators.dedup import dedup_by_key
from strata.plans import orders as OR
from strata.session import new_work_path, shuffles_freed
from strata.sources import bindings as B

# Fixed run dates of the checks (the test tables' own calendars).
ORDERS_AS_OF = "2001-08-01"
FEATURES_AS_OF = "2024-02-13"
# Thresholds scaled to the test tables' lifetime values so every segment occurs.
QUERY_CFG = PipelineConfig(premium_customer_threshold=70000.0, standard_customer_threshold=50000.0)

AUDIT = {"processed_timestamp", "calculated_timestamp", "updated_timestamp", "feature_timestamp",
         "ingestion_timestamp", "source_file"}


def public(df: DataFrame, round6=()) -> DataFrame:
    cols = []
    for c in df.columns:
        if c in AUDIT:
            continue
        cols.append(F.round(F.col(c), 6).alias(c) if c in round6 else F.col(c))
    return df.select(*cols)


def json_orders(df):
    """Orders as the generator writes them: ids and quantity as JSON numbers."""
    return df.select(F.col("order_id").cast("long").alias("order_id"),
                     F.col("customer_id").cast("long").alias("customer_id"), "order_date",
                     F.col("product_id").cast("long").alias("product_id"), "product_name", "category",
                     "quantity", "price", "status")


def first_choice(raw, keys, order_exprs):
    """The preferred row per key, as a keyed aggregate (no window)."""
    tmp = [f"_o{i}" for i in range(len(order_exprs))]
    ranked = raw.select(*raw.columns, *[e.alias(t) for e, t in zip(order_exprs, tmp)])
    return dedup_by_key(ranked, keys, tmp).select(*raw.columns)


#: Hashes of repeated keys that are broadcast; a million takes about 60 MB of a process.
MOST_BROADCAST = 1_000_000


def orders_first_and_rest(spark, sf_dir):
    """Raw JSON orders in two parts: the row that the batch dedup keeps of each key, and
    the others. The raw rows are joined once and written; only rows of keys whose hash
    occurs several times are compared (a key that shares its hash with another one is
    one of them, and stays), so other rows cross the network by that hash alone, unless
    the repeated ones are more than ``MOST_BROADCAST``."""
    path = new_work_path(spark, "orders_first_and_rest")
    key = F.xxhash64(*OR.ORDER_KEYS)
    with shuffles_freed(spark):
        json_orders(B.raw_orders(spark, sf_dir)).write.parquet(f"{path}/raw")
        raw = spark.read.parquet(f"{path}/raw")
        raw.groupBy(key.alias("_key")).count().filter("count > 1").select("_key").write.parquet(f"{path}/repeated")
        repeated = spark.read.parquet(f"{path}/repeated")
        if repeated.count() <= MOST_BROADCAST:
            repeated = F.broadcast(repeated)
        raw.join(repeated, key == F.col("_key"), "left_semi").write.parquet(f"{path}/several")
    several = spark.read.parquet(f"{path}/several")
    kept = first_choice(several, OR.ORDER_KEYS, [
        F.col("quantity"), F.col("price"), F.coalesce(F.col("status"), F.lit("unknown")),
        F.col("customer_id").cast("string"), parse_date("order_date"),
        F.coalesce(F.col("product_name"), F.lit("unknown")),
        F.coalesce(F.col("category"), F.lit("uncategorized"))])
    return raw.join(repeated, key == F.col("_key"), "left_anti").unionByName(kept), several.exceptAll(kept)
