"""Sample edition of the orders pipeline: DS-16..20 (DS-15 is the inferred-schema reader).

No dedup, unrounded line total, three drop-expectations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import dates as D
from strata.operators.expectations import SAMPLE_SILVER_ORDERS_EXPECTATIONS, apply_expectations


def sample_silver_orders(bronze: DataFrame, observe: bool = True):
    """DS-16. Returns ``(df, metrics)``."""
    df = (bronze
          .withColumn("order_date", D.parse_date("order_date"))
          .withColumn("status", F.coalesce(F.col("status"), F.lit("unknown")))
          .withColumn("total_item_price", F.col("price") * F.col("quantity"))
          .withColumn("processed_timestamp", F.current_timestamp()))
    return apply_expectations(df, SAMPLE_SILVER_ORDERS_EXPECTATIONS, "sample_silver_orders", observe)


def sample_silver_customers(silver: DataFrame, as_of=None) -> DataFrame:
    """DS-17: distinct customers; first_seen is the run date (AGG-10, PRJ-3)."""
    return silver.select("customer_id").distinct().withColumn("first_seen", D.today(as_of))


def sample_daily_sales(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """DS-18."""
    df = (silver.groupBy("order_date", "category")
          .agg(F.count_distinct("order_id").alias("total_orders"),
               F.sum("quantity").alias("total_items_sold"),
               F.sum("total_item_price").alias("total_revenue")))
    return df.orderBy("order_date", "category") if ordered else df


def sample_customer_insights(silver: DataFrame) -> DataFrame:
    """DS-19."""
    return (silver.groupBy("customer_id")
            .agg(F.count_distinct("order_id").alias("total_orders"),
                 F.sum("total_item_price").alias("lifetime_value"),
                 F.avg("total_item_price").alias("avg_order_value"),
                 F.max("order_date").alias("latest_order_date")))


def sample_product_performance(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """DS-20."""
    df = (silver.groupBy("product_id", "product_name", "category")
          .agg(F.sum("quantity").alias("total_units_sold"),
               F.sum("total_item_price").alias("total_revenue"),
               F.avg("price").alias("avg_price")))
    return df.orderBy(F.col("total_revenue").desc()) if ordered else df
