"""Orders pipeline: DS-2 silver orders, DS-3 silver customers, DS-4..7 gold.

Every dataset is a plain function over DataFrames; the same row transforms
(``normalize_orders`` before the dedup, ``derive_order_columns`` after it)
serve the batch and the streaming silver table. Audit columns use
``current_timestamp()``; the run date is ``as_of`` (None = today).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.functions import dates as D
from strata.functions import segments as S
from strata.operators.dedup import ORDERED, dedup
from strata.operators.distinct import agg_with_distinct
from strata.operators.expectations import (SILVER_CUSTOMERS_EXPECTATIONS, apply_expectations,
                                           silver_orders_expectations)

ORDER_KEYS = ["order_id", "product_id"]
# Repeatable choice among duplicate keys (NULLs first); the stream keeps first arrival.
ORDER_DEDUP_ORDER = ["quantity", "price", "status", "customer_id", "order_date",
                     "product_name", "category"]

SILVER_ORDERS_COLUMNS = [
    "order_id", "customer_id", "order_date", "product_id", "product_name",
    "category", "quantity", "price", "status", "total_item_price",
    "processed_timestamp", "order_year", "order_month", "order_quarter",
    "order_day_of_week", "price_tier", "source_file",
]


def normalize_orders(bronze: DataFrame) -> DataFrame:
    """Parsed date and NULL defaults: the columns the dedup order looks at (FN-1, FN-10)."""
    if "source_file" not in bronze.columns:
        bronze = bronze.withColumn("source_file", F.lit(None).cast("string"))
    return bronze.withColumns({
        "order_date": D.parse_date("order_date"),
        "status": F.coalesce(F.col("status"), F.lit("unknown")),
        "category": F.coalesce(F.col("category"), F.lit("uncategorized")),
        "product_name": F.coalesce(F.col("product_name"), F.lit("unknown")),
    })


def derive_order_columns(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Per-row derived columns (FN-4, FN-5, FN-11, SEG-1, audit)."""
    d = F.col("order_date")
    return df.withColumns({
        "total_item_price": F.round(F.col("price") * F.col("quantity"), 2),
        "processed_timestamp": F.current_timestamp(),
        "order_year": F.year(d),
        "order_month": F.month(d),
        "order_quarter": F.quarter(d),
        "order_day_of_week": F.dayofweek(d),
        "price_tier": S.price_tier(cfg),
    })


def clean_orders(bronze: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Stateless row work of silver orders, without dedup."""
    return derive_order_columns(normalize_orders(bronze), cfg)


def silver_orders(bronze: DataFrame, cfg: PipelineConfig, dedup_mode: str = ORDERED,
                  watermark: bool = True, observe: bool = True):
    """DS-2. Returns ``(df, metrics)``.

    Order of operations keeps the published semantics: row transform, dedup on
    (order_id, product_id), then the seven drop-expectations on the output.
    The derived columns are pure functions of the row, so they are computed
    after the dedup: the dedup shuffle carries only the raw columns.

    ``dedup_mode="valid_first"`` lets a key's first valid row stay instead, so that a
    bad first duplicate doesn't lose a good one.
    """
    df = bronze
    if watermark and df.isStreaming:
        df = df.withWatermark("ingestion_timestamp", cfg.watermark_delay)
    valid = reduce(Column.__and__, [e.passed() for e in silver_orders_expectations(cfg)])
    df = dedup(normalize_orders(df), ORDER_KEYS, dedup_mode, ORDER_DEDUP_ORDER, valid)
    df = derive_order_columns(df, cfg).select(*SILVER_ORDERS_COLUMNS)
    return apply_expectations(df, silver_orders_expectations(cfg), "silver_orders", observe)


def silver_customers(silver: DataFrame, cfg: PipelineConfig, observe: bool = False):
    """DS-3: customer dimension (first/latest order, lifetime value, SEG-2)."""
    df = (silver.groupBy("customer_id")
          .agg(F.min("order_date").alias("first_order_date"),
               F.max("order_date").alias("latest_order_date"),
               F.count_distinct("order_id").alias("total_orders"),
               F.sum("total_item_price").alias("lifetime_value"),
               F.count(F.lit(1)).alias("total_items_purchased"))
          .withColumn("customer_tenure_days", F.datediff("latest_order_date", "first_order_date"))
          .withColumn("customer_segment", S.customer_segment(cfg))
          .withColumn("updated_timestamp", F.current_timestamp()))
    return apply_expectations(df, SILVER_CUSTOMERS_EXPECTATIONS, "silver_customers", observe)[0]


def silver_customers_from_insights(insights: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """DS-3 derived from DS-5's per-customer aggregate (same figures: the
    line-item count is ``total_line_items``), so a pipeline run aggregates
    silver by customer once instead of twice."""
    df = (insights.select("customer_id", "first_order_date", "latest_order_date", "total_orders",
                          "lifetime_value", F.col("total_line_items").alias("total_items_purchased"))
          .withColumn("customer_tenure_days", F.datediff("latest_order_date", "first_order_date"))
          .withColumn("customer_segment", S.customer_segment(cfg))
          .withColumn("updated_timestamp", F.current_timestamp()))
    return apply_expectations(df, SILVER_CUSTOMERS_EXPECTATIONS, "silver_customers", False)[0]


def gold_daily_sales(silver: DataFrame, cfg: PipelineConfig, ordered: bool = True) -> DataFrame:
    """DS-4: per (date, category) sales; "order value" figures are per line item."""
    df = (silver.groupBy("order_date", "category", "order_year", "order_month")
          .agg(F.count_distinct("order_id").alias("total_orders"),
               F.count_distinct("customer_id").alias("unique_customers"),
               F.sum("quantity").alias("total_items_sold"),
               F.sum("total_item_price").alias("total_revenue"),
               F.avg("total_item_price").alias("avg_order_value"),
               F.min("total_item_price").alias("min_order_value"),
               F.max("total_item_price").alias("max_order_value"),
               F.stddev_samp("total_item_price").alias("order_value_stddev"),
               F.avg("quantity").alias("avg_items_per_order"))
          .withColumn("revenue_per_customer", S.per_unit("total_revenue", "unique_customers"))
          .withColumn("items_per_customer", S.per_unit("total_items_sold", "unique_customers"))
          .withColumn("calculated_timestamp", F.current_timestamp()))
    return df.orderBy("order_date", "category") if ordered else df


def gold_customer_insights(silver: DataFrame, cfg: PipelineConfig, as_of=None) -> DataFrame:
    """DS-5: per-customer behaviour with frequency, value and recency segments."""
    by_customer = (silver.groupBy("customer_id")
                   .agg(F.count_distinct("order_id").alias("total_orders"),
                        F.count_distinct("product_id").alias("unique_products_purchased"),
                        F.count_distinct("category").alias("categories_shopped"),
                        F.sum("total_item_price").alias("lifetime_value"),
                        F.avg("total_item_price").alias("avg_order_value"),
                        F.sum("quantity").alias("total_items_purchased"),
                        F.max("order_date").alias("latest_order_date"),
                        F.min("order_date").alias("first_order_date"),
                        F.count(F.lit(1)).alias("total_line_items")))
    return customer_insight_columns(by_customer, cfg, as_of)


def customer_insight_columns(by_customer: DataFrame, cfg: PipelineConfig, as_of=None) -> DataFrame:
    """What DS-5 derives from a customer's figures."""
    return (by_customer
            .withColumn("customer_tenure_days", F.datediff("latest_order_date", "first_order_date"))
            .withColumn("days_since_last_order", D.days_since("latest_order_date", as_of))
            .withColumn("avg_days_between_orders", S.avg_days_between())
            .withColumn("customer_frequency_segment", S.frequency_segment(cfg))
            .withColumn("customer_value_segment", S.value_segment(cfg))
            .withColumn("customer_recency_segment", S.recency_segment(cfg))
            .withColumn("calculated_timestamp", F.current_timestamp()))


def gold_product_performance(silver: DataFrame, cfg: PipelineConfig, ordered: bool = True) -> DataFrame:
    """DS-6: per-product sales, popularity and price stability."""
    keys = ["product_id", "product_name", "category"]
    by_product = agg_with_distinct(
        silver.select(*keys, "customer_id", "order_id", "quantity", "total_item_price", "price", "order_date"), keys,
        [F.sum("quantity").alias("total_units_sold"),
         F.sum("total_item_price").alias("total_revenue"),
         F.avg("price").alias("avg_price"),
         F.min("price").alias("min_price"),
         F.max("price").alias("max_price"),
         F.avg("quantity").alias("avg_quantity_per_order"),
         F.max("order_date").alias("latest_order_date"),
         F.min("order_date").alias("first_order_date")],
        {"unique_customers": "customer_id", "unique_orders": "order_id"})
    by_product = by_product.select(*keys, "total_units_sold", "total_revenue", "unique_customers", "unique_orders", "avg_price", "min_price",
                                   "max_price", "avg_quantity_per_order", "latest_order_date", "first_order_date")
    df = product_performance_columns(by_product)
    return df.orderBy(F.col("total_revenue").desc()) if ordered else df


def product_performance_columns(by_product: DataFrame) -> DataFrame:
    """What DS-6 derives from a product's figures."""
    return (by_product
            .withColumn("revenue_per_customer", S.per_unit("total_revenue", "unique_customers"))
            .withColumn("product_popularity_score", S.popularity_score())
            .withColumn("price_stability", S.price_stability())
            .withColumn("product_lifecycle_days", F.datediff("latest_order_date", "first_order_date"))
            .withColumn("calculated_timestamp", F.current_timestamp()))


REAL_TIME_COLUMNS = ["todays_orders", "todays_revenue", "todays_customers", "todays_avg_order_value",
                     "metric_date", "metric_type", "orders_7d", "revenue_7d", "customers_7d",
                     "avg_order_value_7d"]
_REAL_TIME_TYPES = ["bigint", "double", "bigint", "double", "date", "string",
                    "bigint", "double", "bigint", "double"]


def gold_real_time_metrics(silver: DataFrame, cfg: PipelineConfig, as_of=None) -> DataFrame:
    """DS-7: a "daily" row and a "7_day_rolling" row, each with the other's
    metrics NULL (SET-1: the union by name of two one-row aggregates).

    One scan: the 7-day filter (a superset of today, pushed to the scan and, on a
    table partitioned by order_date, pruning partitions) feeds one global
    aggregate with conditional metrics for both windows, and both output rows
    are cut from that single aggregate row. (A ``unionByName`` of two
    projections of the aggregate would be pruned differently per branch and
    recompute the whole input twice.)
    """
    run_date = D.today(as_of)
    recent = silver.filter(F.col("order_date") >= D.days_before(7, as_of))
    is_today = F.col("order_date") == run_date
    tip = F.col("total_item_price")
    m = recent.agg(
        F.count_if(is_today).alias("todays_orders"),
        F.sum(F.when(is_today, tip)).alias("todays_revenue"),
        F.count_distinct(F.when(is_today, F.col("customer_id"))).alias("todays_customers"),
        F.avg(F.when(is_today, tip)).alias("todays_avg_order_value"),
        F.count(F.lit(1)).alias("orders_7d"),
        F.sum(tip).alias("revenue_7d"),
        F.count_distinct("customer_id").alias("customers_7d"),
        F.avg(tip).alias("avg_order_value_7d"),
    )
    daily = {"todays_orders", "todays_revenue", "todays_customers", "todays_avg_order_value"}
    rolling = {"orders_7d", "revenue_7d", "customers_7d", "avg_order_value_7d"}

    def row(kind: str, own: set):
        fields = []
        for name, typ in zip(REAL_TIME_COLUMNS, _REAL_TIME_TYPES):
            if name == "metric_date":
                v = run_date
            elif name == "metric_type":
                v = F.lit(kind)
            else:
                v = F.col(name) if name in own else F.lit(None)
            fields.append(v.cast(typ).alias(name))
        return F.struct(*fields)

    return m.select(F.inline(F.array(row("daily", daily), row("7_day_rolling", rolling))))
