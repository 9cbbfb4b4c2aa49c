"""Registered queries: one per dataset / operator family, each with its oracle SQL.

Every query reads the driver's tables under ``sf_dir`` (through the raw-input
bindings) and runs over them whole. Scenario queries (JSON hand-over, triggered
streams, incremental refresh) write their intermediate data under the shared
folder and return the batch read of the resulting table. Outputs leave out audit timestamps and
file lineage (run-dependent) and compare sample standard deviations at 6
decimals; everything else is the dataset as the pipeline produces it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.expectations import expectation_metrics, silver_orders_expectations
from strata.plans import features as FT
from strata.plans import orders as OR
from strata.plans import sample as SM
from strata.plans import scenarios as SC
from strata.plans.oracle_sql import (BEHAVIOR_CTE, ORACLE_RAW_ACTIVITY, ORACLE_RAW_ORDERS, ORACLE_RAW_PROFILES,
                                     engagement_cte, gen_activity_sql, gen_orders_sql, gen_profiles_sql,
                                     silver_activity_cte, silver_orders_cte, silver_profile_cte, sround)
from strata.plans.query_inputs import FEATURES_AS_OF, ORDERS_AS_OF, QUERY_CFG, json_orders, orders_first_and_rest, public
from strata.session import shuffles_freed
from strata.sinks import snapshots
from strata.sources import bindings as B

# ---------------------------------------------------------------- orders

def _silver_orders(spark, sf_dir, cfg=QUERY_CFG):
    bronze = B.as_bronze(B.raw_orders(spark, sf_dir))
    return OR.silver_orders(bronze, cfg, observe=False)[0]


def q_expect_or_drop_orders(spark, sf_dir):
    """DQ-2 over raw orders without dedup: the rows that pass all seven expectations."""
    from strata.operators.expectations import apply_expectations
    clean = OR.clean_orders(B.as_bronze(B.raw_orders(spark, sf_dir)), QUERY_CFG)
    kept = apply_expectations(clean, silver_orders_expectations(QUERY_CFG), "orders", observe=False)[0]
    return kept.groupBy("order_date", "price_tier").agg(
        F.count(F.lit(1)).alias("rows_kept"), F.sum("quantity").alias("quantity_kept"))


def q_expect_metrics(spark, sf_dir):
    clean = OR.clean_orders(B.as_bronze(B.raw_orders(spark, sf_dir)), QUERY_CFG)
    return expectation_metrics(clean, silver_orders_expectations(QUERY_CFG), "silver_orders")


def q_silver_orders(spark, sf_dir):
    return public(_silver_orders(spark, sf_dir))


def q_silver_customers(spark, sf_dir):
    return public(OR.silver_customers(_silver_orders(spark, sf_dir), QUERY_CFG))


def q_gold_daily_sales(spark, sf_dir):
    return public(OR.gold_daily_sales(_silver_orders(spark, sf_dir), QUERY_CFG), {"order_value_stddev"})


def q_gold_customer_insights(spark, sf_dir):
    return public(OR.gold_customer_insights(_silver_orders(spark, sf_dir), QUERY_CFG, ORDERS_AS_OF))


def q_gold_product_performance(spark, sf_dir):
    return public(OR.gold_product_performance(_silver_orders(spark, sf_dir), QUERY_CFG))


def q_gold_real_time_metrics(spark, sf_dir):
    return OR.gold_real_time_metrics(_silver_orders(spark, sf_dir), QUERY_CFG, ORDERS_AS_OF)


_SO = silver_orders_cte(QUERY_CFG.max_quantity, QUERY_CFG.max_price)

SQL_SILVER_ORDERS = f"WITH {_SO} SELECT * FROM silver_orders"

SQL_EXPECT_OR_DROP = f"""WITH raw_orders AS ({ORACLE_RAW_ORDERS}),
c AS (SELECT *, CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS d,
  CASE WHEN price <= 10.0 THEN 'Low' WHEN price <= 100.0 THEN 'Medium' ELSE 'High' END AS price_tier
  FROM raw_orders)
SELECT d AS order_date, price_tier, count(*) AS rows_kept, CAST(sum(quantity) AS BIGINT) AS quantity_kept
FROM c
WHERE order_id IS NOT NULL AND length(trim(order_id)) > 0
  AND customer_id IS NOT NULL AND length(trim(customer_id)) > 0
  AND product_id IS NOT NULL AND length(trim(product_id)) > 0
  AND d IS NOT NULL AND length(CAST(d AS VARCHAR)) = 10
  AND quantity > 0 AND quantity <= {QUERY_CFG.max_quantity}
  AND price > 0 AND price <= {QUERY_CFG.max_price}
  AND regexp_matches(CAST(d AS VARCHAR), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
GROUP BY 1, 2"""

SQL_EXPECT_METRICS = f"""WITH raw_orders AS ({ORACLE_RAW_ORDERS}),
c AS (SELECT *, CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS d FROM raw_orders),
m AS (SELECT count(*) AS total_records,
  count(*) FILTER (WHERE order_id IS NOT NULL AND length(trim(order_id)) > 0) AS p0,
  count(*) FILTER (WHERE customer_id IS NOT NULL AND length(trim(customer_id)) > 0) AS p1,
  count(*) FILTER (WHERE product_id IS NOT NULL AND length(trim(product_id)) > 0) AS p2,
  count(*) FILTER (WHERE d IS NOT NULL AND length(CAST(d AS VARCHAR)) = 10) AS p3,
  count(*) FILTER (WHERE quantity > 0 AND quantity <= {QUERY_CFG.max_quantity}) AS p4,
  count(*) FILTER (WHERE price > 0 AND price <= {QUERY_CFG.max_price}) AS p5,
  count(*) FILTER (WHERE regexp_matches(CAST(d AS VARCHAR), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) AS p6
  FROM c)
SELECT 'silver_orders' AS dataset, e.expectation, 'drop' AS mode, total_records,
  CASE e.i WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 WHEN 4 THEN p4 WHEN 5 THEN p5 ELSE p6 END
    AS passed_records,
  total_records - CASE e.i WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 WHEN 4 THEN p4
    WHEN 5 THEN p5 ELSE p6 END AS failed_records
FROM m, (VALUES (0, 'valid_order_id'), (1, 'valid_customer_id'), (2, 'valid_product_id'),
  (3, 'valid_order_date'), (4, 'valid_quantity'), (5, 'valid_price'), (6, 'valid_order_date_format'))
  AS e(i, expectation)"""

SQL_SILVER_CUSTOMERS = f"""WITH {_SO}
SELECT *, CASE WHEN lifetime_value >= {QUERY_CFG.premium_customer_threshold} THEN 'Premium'
  WHEN lifetime_value >= {QUERY_CFG.standard_customer_threshold} THEN 'Standard' ELSE 'Basic' END AS customer_segment
FROM (SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS latest_order_date,
  count(DISTINCT order_id) AS total_orders, sum(total_item_price) AS lifetime_value,
  count(*) AS total_items_purchased,
  CAST(max(order_date) - min(order_date) AS INTEGER) AS customer_tenure_days
  FROM silver_orders WHERE customer_id IS NOT NULL GROUP BY customer_id)"""

SQL_GOLD_DAILY_SALES = f"""WITH {_SO},
g AS (SELECT order_date, category, order_year, order_month,
  count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  CAST(sum(quantity) AS BIGINT) AS total_items_sold, sum(total_item_price) AS total_revenue,
  avg(total_item_price) AS avg_order_value, min(total_item_price) AS min_order_value,
  max(total_item_price) AS max_order_value,
  {sround('stddev_samp(total_item_price)', 6)} AS order_value_stddev,
  avg(quantity) AS avg_items_per_order
  FROM silver_orders GROUP BY order_date, category, order_year, order_month)
SELECT *, {sround('total_revenue / unique_customers', 2)} AS revenue_per_customer,
  {sround('CAST(total_items_sold AS DOUBLE) / unique_customers', 2)} AS items_per_customer
FROM g"""

SQL_GOLD_CUSTOMER_INSIGHTS = f"""WITH {_SO},
g AS (SELECT customer_id, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT product_id) AS unique_products_purchased, count(DISTINCT category) AS categories_shopped,
  sum(total_item_price) AS lifetime_value, avg(total_item_price) AS avg_order_value,
  CAST(sum(quantity) AS BIGINT) AS total_items_purchased, max(order_date) AS latest_order_date,
  min(order_date) AS first_order_date, count(*) AS total_line_items
  FROM silver_orders GROUP BY customer_id),
d AS (SELECT *, CAST(latest_order_date - first_order_date AS INTEGER) AS customer_tenure_days,
  CAST(DATE '{ORDERS_AS_OF}' - latest_order_date AS INTEGER) AS days_since_last_order FROM g)
SELECT *,
  CASE WHEN total_orders > 1 THEN CAST(customer_tenure_days AS DOUBLE) / (total_orders - 1) END
    AS avg_days_between_orders,
  CASE WHEN total_orders >= 10 THEN 'Frequent' WHEN total_orders >= 5 THEN 'Regular'
    WHEN total_orders >= 2 THEN 'Occasional' ELSE 'One-time' END AS customer_frequency_segment,
  CASE WHEN lifetime_value >= {QUERY_CFG.premium_customer_threshold} THEN 'High Value'
    WHEN lifetime_value >= {QUERY_CFG.standard_customer_threshold} THEN 'Medium Value'
    ELSE 'Low Value' END AS customer_value_segment,
  CASE WHEN days_since_last_order <= 30 THEN 'Recent' WHEN days_since_last_order <= 90 THEN 'Moderately Recent'
    WHEN days_since_last_order <= 180 THEN 'At Risk' ELSE 'Dormant' END AS customer_recency_segment
FROM d"""

SQL_GOLD_PRODUCT_PERFORMANCE = f"""WITH {_SO},
g AS (SELECT product_id, product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  sum(total_item_price) AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT order_id) AS unique_orders, avg(price) AS avg_price, min(price) AS min_price,
  max(price) AS max_price, avg(quantity) AS avg_quantity_per_order,
  max(order_date) AS latest_order_date, min(order_date) AS first_order_date
  FROM silver_orders GROUP BY product_id, product_name, category)
SELECT *, {sround('total_revenue / unique_customers', 2)} AS revenue_per_customer,
  {sround('(CAST(unique_customers AS DOUBLE) * CAST(0.4 AS DOUBLE) + CAST(total_units_sold AS DOUBLE) * CAST(0.6 AS DOUBLE)) / CAST(100 AS DOUBLE)', 2)}
    AS product_popularity_score,
  CASE WHEN min_price = max_price THEN 'Stable'
    WHEN (max_price - min_price) / avg_price <= 0.1 THEN 'Low Variance'
    WHEN (max_price - min_price) / avg_price <= 0.3 THEN 'Medium Variance'
    ELSE 'High Variance' END AS price_stability,
  CAST(latest_order_date - first_order_date AS INTEGER) AS product_lifecycle_days
FROM g"""

SQL_GOLD_REAL_TIME_METRICS = f"""WITH {_SO}
SELECT count(*) AS todays_orders, sum(total_item_price) AS todays_revenue,
  count(DISTINCT customer_id) AS todays_customers, avg(total_item_price) AS todays_avg_order_value,
  DATE '{ORDERS_AS_OF}' AS metric_date, 'daily' AS metric_type,
  CAST(NULL AS BIGINT) AS orders_7d, CAST(NULL AS DOUBLE) AS revenue_7d,
  CAST(NULL AS BIGINT) AS customers_7d, CAST(NULL AS DOUBLE) AS avg_order_value_7d
FROM silver_orders WHERE order_date = DATE '{ORDERS_AS_OF}'
UNION ALL
SELECT NULL, NULL, NULL, NULL, DATE '{ORDERS_AS_OF}', '7_day_rolling',
  count(*), sum(total_item_price), count(DISTINCT customer_id), avg(total_item_price)
FROM silver_orders WHERE order_date >= DATE '{ORDERS_AS_OF}' - INTERVAL 7 DAY"""


# ---------------------------------------------------------------- features

def _silver_activity(spark, sf_dir):
    return FT.silver_customer_activity(B.as_bronze(B.raw_activity(spark, sf_dir)), QUERY_CFG, observe=False)[0]


def _silver_profile(spark, sf_dir):
    bronze = B.raw_profiles(spark, sf_dir).withColumn("ingestion_timestamp", F.current_timestamp())
    return FT.silver_customer_profile(bronze, QUERY_CFG, FEATURES_AS_OF, observe=False)[0]


def q_silver_customer_activity(spark, sf_dir):
    return public(_silver_activity(spark, sf_dir))


def q_silver_customer_profile(spark, sf_dir):
    return public(_silver_profile(spark, sf_dir))


def q_features_customer_engagement(spark, sf_dir):
    return public(FT.gold_features_customer_engagement(_silver_activity(spark, sf_dir), FEATURES_AS_OF),
                   {"engagement_score_stddev"})


def q_device_pivot(spark, sf_dir):
    return FT.device_pivot(_silver_activity(spark, sf_dir))


def q_features_customer_behavior(spark, sf_dir):
    return FT.gold_features_customer_behavior(_silver_activity(spark, sf_dir))


def q_features_customer_behavior_joined(spark, sf_dir):
    return FT.gold_features_customer_behavior(_silver_activity(spark, sf_dir), fused=False)


def q_ml_feature_table(spark, sf_dir):
    return public(FT.ml_feature_table(_silver_activity(spark, sf_dir), _silver_profile(spark, sf_dir),
                                       FEATURES_AS_OF), {"engagement_score_stddev"})


def q_features_customer_locations(spark, sf_dir):
    """AGG-8: the set of locations of each customer, in order."""
    rows = FT.gold_features_customer_behavior(_silver_activity(spark, sf_dir), keep_locations=True)
    return rows.select("customer_id", "unique_locations", F.array_join(F.array_sort("locations_visited"), ",").alias("locations_visited"))


def q_ml_feature_table_joined(spark, sf_dir):
    """JOIN-2: engagement and behaviour as tables of their own, joined."""
    silver = _silver_activity(spark, sf_dir)
    return public(FT.ml_feature_table(None, _silver_profile(spark, sf_dir), FEATURES_AS_OF, FT.gold_features_customer_engagement(silver, FEATURES_AS_OF),
                                      FT.gold_features_customer_behavior(silver)), {"engagement_score_stddev"})


_SA = silver_activity_cte()
_SP = silver_profile_cte(FEATURES_AS_OF)

SQL_SILVER_ACTIVITY = f"WITH {_SA} SELECT * FROM silver_activity"

SQL_SILVER_PROFILE = f"""WITH {_SP}
SELECT customer_id, signup_date, age_group, gender, income_bracket, loyalty_tier, signup_date_parsed,
  days_since_signup, customer_vintage_segment FROM silver_profile_seg"""

SQL_ENGAGEMENT = f"""WITH {_SA}, {engagement_cte(FEATURES_AS_OF)}
SELECT * FROM engagement"""

SQL_DEVICE_PIVOT = f"""WITH {_SA}
SELECT customer_id, count(*) FILTER (WHERE device = 'desktop') AS desktop_sessions,
  count(*) FILTER (WHERE device = 'mobile') AS mobile_sessions,
  count(*) FILTER (WHERE device = 'tablet') AS tablet_sessions
FROM silver_activity GROUP BY customer_id"""

SQL_BEHAVIOR = f"WITH {_SA}, {BEHAVIOR_CTE} SELECT * FROM behavior"

SQL_LOCATIONS = f"""WITH {_SA}
SELECT customer_id, count(DISTINCT location) AS unique_locations,
  coalesce(array_to_string(list_sort(list_distinct(list(location))), ','), '') AS locations_visited
FROM silver_activity GROUP BY customer_id"""

SQL_ML_FEATURES = f"""WITH {_SA}, {_SP}, {engagement_cte(FEATURES_AS_OF)}, {BEHAVIOR_CTE}
SELECT e.customer_id, total_page_views, total_cart_adds, total_purchases, avg_engagement_score,
  max_engagement_score, engagement_score_stddev, active_days, total_sessions, weekend_activity_days,
  avg_page_views_per_session, conversion_rate_cart_to_purchase, days_since_last_activity,
  activity_consistency_score, avg_activity_hour, desktop_sessions, mobile_sessions, tablet_sessions,
  device_total_sessions, mobile_preference_score, desktop_preference_score, multi_device_user,
  unique_locations, age_group, gender, income_bracket, loyalty_tier, days_since_signup,
  customer_vintage_segment,
  CASE WHEN days_since_last_activity > 30 OR avg_engagement_score < 3 THEN 'high'
    WHEN days_since_last_activity > 14 OR avg_engagement_score < 8 THEN 'medium' ELSE 'low' END
    AS churn_risk_score,
  CASE WHEN total_purchases >= 20 THEN 'high_value' WHEN total_purchases >= 10 THEN 'medium_value'
    WHEN total_purchases >= 3 THEN 'low_value' ELSE 'minimal_value' END AS customer_value_segment,
  CASE WHEN avg_engagement_score >= 20 THEN 'highly_engaged' WHEN avg_engagement_score >= 10 THEN 'moderately_engaged'
    WHEN avg_engagement_score >= 5 THEN 'lightly_engaged' ELSE 'disengaged' END AS engagement_level
FROM engagement e LEFT JOIN behavior b ON e.customer_id = b.customer_id
LEFT JOIN silver_profile_seg p ON e.customer_id = p.customer_id"""


def q_expect_warn_orders(spark, sf_dir):
    """DQ-1: the seven order expectations in warn mode keep every row."""
    from strata.operators.expectations import WARN, Expectation, apply_expectations
    clean = OR.clean_orders(B.as_bronze(B.raw_orders(spark, sf_dir)), QUERY_CFG)
    warn = [Expectation(e.name, e.predicate, WARN) for e in silver_orders_expectations(QUERY_CFG)]
    kept = apply_expectations(clean, warn, "orders_warn", observe=False)[0]
    return kept.groupBy("price_tier").agg(F.count(F.lit(1)).alias("rows_kept"))


def q_expect_or_fail_silver(spark, sf_dir):
    """DQ-3 on silver orders: every row satisfies the fail-mode checks, so all are kept."""
    from strata.operators.expectations import apply_expectations, expect_or_fail
    checks = [expect_or_fail("positive_total", "total_item_price > 0"),
              expect_or_fail("known_status", "status IS NOT NULL")]
    checked = apply_expectations(_silver_orders(spark, sf_dir), checks, "silver_orders_fail", observe=False)[0]
    return checked.groupBy("price_tier").agg(F.count(F.lit(1)).alias("rows_kept"),
                                             F.sum("quantity").alias("quantity_kept"))


SQL_EXPECT_WARN = f"""WITH raw_orders AS ({ORACLE_RAW_ORDERS})
SELECT CASE WHEN price <= 10.0 THEN 'Low' WHEN price <= 100.0 THEN 'Medium' ELSE 'High' END AS price_tier,
  count(*) AS rows_kept
FROM raw_orders GROUP BY 1"""

SQL_EXPECT_FAIL = f"""WITH {_SO}
SELECT price_tier, count(*) AS rows_kept, CAST(sum(quantity) AS BIGINT) AS quantity_kept
FROM silver_orders GROUP BY price_tier"""


def q_expect_metrics_activity(spark, sf_dir):
    """DQ-4 for the activity expectations (DQ-18..22) over the raw activity."""
    from strata.operators.expectations import SILVER_ACTIVITY_EXPECTATIONS
    return expectation_metrics(B.raw_activity(spark, sf_dir), SILVER_ACTIVITY_EXPECTATIONS,
                               "silver_customer_activity")


def q_expect_metrics_profiles(spark, sf_dir):
    """DQ-4 for the profile expectations (DQ-23, 24) over the raw profiles."""
    from strata.operators.expectations import SILVER_PROFILE_EXPECTATIONS
    return expectation_metrics(B.raw_profiles(spark, sf_dir), SILVER_PROFILE_EXPECTATIONS,
                               "silver_customer_profile")


def q_silver_customers_derived(spark, sf_dir):
    """DS-3 as a pipeline run builds it: projected from the customer-insights aggregate."""
    ins = OR.gold_customer_insights(_silver_orders(spark, sf_dir), QUERY_CFG, ORDERS_AS_OF)
    return public(OR.silver_customers_from_insights(ins, QUERY_CFG))


SQL_EXPECT_METRICS_ACTIVITY = f"""WITH r AS ({ORACLE_RAW_ACTIVITY}),
m AS (SELECT count(*) AS total_records,
  count(*) FILTER (WHERE customer_id IS NOT NULL) AS p0,
  count(*) FILTER (WHERE "timestamp" IS NOT NULL AND "timestamp" != 'invalid-timestamp') AS p1,
  count(*) FILTER (WHERE page_views >= 0) AS p2,
  count(*) FILTER (WHERE cart_adds >= 0) AS p3,
  count(*) FILTER (WHERE purchases >= 0) AS p4
  FROM r)
SELECT 'silver_customer_activity' AS dataset, e.expectation, 'drop' AS mode, total_records,
  CASE e.i WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END AS passed_records,
  total_records - CASE e.i WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 WHEN 3 THEN p3 ELSE p4 END
    AS failed_records
FROM m, (VALUES (0, 'valid_customer_id'), (1, 'valid_timestamp'), (2, 'valid_page_views'),
  (3, 'valid_cart_adds'), (4, 'valid_purchases')) AS e(i, expectation)"""

SQL_EXPECT_METRICS_PROFILES = f"""WITH r AS ({ORACLE_RAW_PROFILES}),
m AS (SELECT count(*) AS total_records, count(*) FILTER (WHERE customer_id IS NOT NULL) AS p0,
  count(*) FILTER (WHERE signup_date IS NOT NULL) AS p1 FROM r)
SELECT 'silver_customer_profile' AS dataset, e.expectation, 'drop' AS mode, total_records,
  CASE e.i WHEN 0 THEN p0 ELSE p1 END AS passed_records,
  total_records - CASE e.i WHEN 0 THEN p0 ELSE p1 END AS failed_records
FROM m, (VALUES (0, 'valid_customer_profile_id'), (1, 'valid_signup_date')) AS e(i, expectation)"""


# ---------------------------------------------------------------- sample edition

def _sample_silver(spark, sf_dir):
    return SM.sample_silver_orders(B.raw_orders_inferred(spark, sf_dir), observe=False)[0]


def q_sample_silver_orders(spark, sf_dir):
    return public(_sample_silver(spark, sf_dir))


def q_sample_silver_customers(spark, sf_dir):
    return SM.sample_silver_customers(_sample_silver(spark, sf_dir), ORDERS_AS_OF)


def q_sample_daily_sales(spark, sf_dir):
    return SM.sample_daily_sales(_sample_silver(spark, sf_dir))


def q_sample_customer_insights(spark, sf_dir):
    return SM.sample_customer_insights(_sample_silver(spark, sf_dir))


def q_sample_product_performance(spark, sf_dir):
    return SM.sample_product_performance(_sample_silver(spark, sf_dir))


def q_top_products(spark, sf_dir):
    """SQL-1 + TOPK-1: ad-hoc SQL over a registered gold view (ties broken by key)."""
    from strata.plans.adhoc import register_views, run_sql
    register_views(spark, {"gold_daily_sales": SM.sample_daily_sales(_sample_silver(spark, sf_dir), ordered=False)})
    return run_sql(spark, "SELECT * FROM gold_daily_sales "
                          "ORDER BY total_revenue DESC, order_date, category LIMIT 10")


SQL_SAMPLE_SILVER = f"""WITH raw_orders AS ({ORACLE_RAW_ORDERS}),
s AS (SELECT category, CAST(customer_id AS BIGINT) AS customer_id,
  CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date, CAST(order_id AS BIGINT) AS order_id,
  price, CAST(product_id AS BIGINT) AS product_id, product_name, CAST(quantity AS BIGINT) AS quantity,
  coalesce(status, 'unknown') AS status, price * CAST(quantity AS BIGINT) AS total_item_price
  FROM raw_orders)
SELECT * FROM s WHERE order_date IS NOT NULL AND length(CAST(order_date AS VARCHAR)) = 10
  AND product_id IS NOT NULL AND quantity > 0"""

SQL_SAMPLE_CUSTOMERS = f"WITH silver AS ({SQL_SAMPLE_SILVER}) " \
                       f"SELECT DISTINCT customer_id, DATE '{ORDERS_AS_OF}' AS first_seen FROM silver"

SQL_SAMPLE_DAILY = f"""WITH silver AS ({SQL_SAMPLE_SILVER})
SELECT order_date, category, count(DISTINCT order_id) AS total_orders,
  CAST(sum(quantity) AS BIGINT) AS total_items_sold, sum(total_item_price) AS total_revenue
FROM silver GROUP BY order_date, category"""

SQL_SAMPLE_INSIGHTS = f"""WITH silver AS ({SQL_SAMPLE_SILVER})
SELECT customer_id, count(DISTINCT order_id) AS total_orders, sum(total_item_price) AS lifetime_value,
  avg(total_item_price) AS avg_order_value, max(order_date) AS latest_order_date
FROM silver GROUP BY customer_id"""

SQL_SAMPLE_PRODUCTS = f"""WITH silver AS ({SQL_SAMPLE_SILVER})
SELECT product_id, product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  sum(total_item_price) AS total_revenue, avg(price) AS avg_price
FROM silver GROUP BY product_id, product_name, category"""

SQL_TOP_PRODUCTS = f"""WITH d AS ({SQL_SAMPLE_DAILY})
SELECT * FROM d ORDER BY total_revenue DESC, order_date, category LIMIT 10"""


# ---------------------------------------------------------------- JSON hand-over and streams

def q_json_round_trip(spark, sf_dir):
    """SNK-1 then SRC-1 (batch): numeric ids come back as strings, missing fields as NULL."""
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_json
    from strata.sources.readers import bronze_orders
    path = write_json(json_orders(B.raw_orders(spark, sf_dir)), new_work_path(spark, "orders_json"), num_files=json_files(B.row_count(spark, sf_dir, "lineitem"), 4))
    return public(bronze_orders(spark, QUERY_CFG, path, stream=False))


def q_sample_bronze_inferred(spark, sf_dir):
    """DS-15 / SRC-5: JSON orders read as a stream with the schema inferred once."""
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_json
    from strata.sources.readers import sample_bronze_orders
    from strata.streaming.runner import StreamLayout, run_to_completion
    from strata.sinks.writers import write_stream
    root = new_work_path(spark, "sample_stream")
    src = write_json(json_orders(B.raw_orders(spark, sf_dir)), f"{root}/orders_raw", num_files=json_files(B.row_count(spark, sf_dir, "lineitem"), 4))
    layout = StreamLayout(root)
    stream = sample_bronze_orders(spark, src, stream=True, options=QUERY_CFG.streaming_options())
    run_to_completion(write_stream(stream, layout.table("bronze_orders"), layout.checkpoint("bronze_orders")))
    return spark.read.parquet(layout.table("bronze_orders"))


def q_json_profiles_round_trip(spark, sf_dir):
    """SNK-1 then SRC-3: profiles through JSON (customer_id read as INT)."""
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_json
    from strata.sources.readers import bronze_customer_profiles
    path = write_json(B.raw_profiles(spark, sf_dir), new_work_path(spark, "profiles_json"), num_files=json_files(B.row_count(spark, sf_dir, "customer"), 2))
    return public(bronze_customer_profiles(spark, QUERY_CFG, path))


def q_json_activity_round_trip(spark, sf_dir):
    """SNK-1 then SRC-2 (batch form of the activity source)."""
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_json
    from strata.sources.readers import bronze_customer_activity
    path = write_json(B.raw_activity(spark, sf_dir), new_work_path(spark, "activity_json"), num_files=json_files(B.row_count(spark, sf_dir, "events"), 3))
    return public(bronze_customer_activity(spark, QUERY_CFG, path, stream=False))


def q_gold_daily_sales_incremental(spark, sf_dir):
    """STR-4 + incremental gold: three triggered updates, daily sales refreshed
    only for the months each update touches; the result must equal the table
    computed in full. Run 1: kept rows dated before 1998; run 2: kept rows from
    1998 on; run 3: every other duplicate (rejected by the dedup state)."""
    from strata.plans.run import refresh_daily_sales
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_hand_over
    from strata.streaming.runner import StreamLayout, run_orders_increment
    rows = B.row_count(spark, sf_dir, "lineitem")
    cfg = QUERY_CFG.with_overrides(max_files_per_trigger=2 * json_files(rows, 2))
    root = new_work_path(spark, "orders_incremental")
    layout = StreamLayout(root)
    first, rest = orders_first_and_rest(spark, sf_dir)
    early = F.coalesce(F.col("order_date") < F.lit("1998-01-01"), F.lit(False))
    for i, part in enumerate((first.filter(early), first.filter(~early), rest), start=1):
        with shuffles_freed(spark):
            write_hand_over(part, f"{root}/orders_raw/run{i}", rows, 2)
        run_orders_increment(spark, cfg, f"{root}/orders_raw/*", layout)
        with shuffles_freed(spark):
            refresh_daily_sales(spark, cfg, layout)
    gold = spark.read.parquet(layout.table("gold_daily_sales"))
    cols = OR.gold_daily_sales(snapshots.read(spark, layout.table("silver_orders")), cfg, ordered=False).columns
    return public(gold.select(*cols), {"order_value_stddev"})


def q_stream_silver_orders(spark, sf_dir):
    """STR-1/2/4/5/6: two triggered runs of bronze -> silver orders.

    Run 1 sees one row per (order_id, product_id) — the row the batch table
    keeps — spread over several files and micro-batches; run 2 sees the other
    rows of the duplicated keys, which the stream's dedup state rejects. The
    result must equal the batch silver table.
    """
    from strata.session import new_work_path
    from strata.sinks.writers import write_hand_over
    from strata.streaming.runner import StreamLayout, run_orders_increment
    rows = B.row_count(spark, sf_dir, "lineitem")
    root = new_work_path(spark, "orders_stream")
    layout = StreamLayout(root)
    first, rest = orders_first_and_rest(spark, sf_dir)
    with shuffles_freed(spark):
        files = write_hand_over(first, f"{root}/orders_raw/run1", rows, 6)
    cfg = QUERY_CFG.with_overrides(max_files_per_trigger=-(-files // 3))
    run_orders_increment(spark, cfg, f"{root}/orders_raw/*", layout)
    with shuffles_freed(spark):
        write_hand_over(rest, f"{root}/orders_raw/run2", rest.count(), 2)
    run_orders_increment(spark, cfg, f"{root}/orders_raw/*", layout)
    return public(snapshots.read(spark, layout.table("silver_orders")).select(*OR.SILVER_ORDERS_COLUMNS))


def q_stream_silver_activity(spark, sf_dir):
    """Two triggered runs of bronze -> silver activity; run 2 replays the whole input again."""
    from strata.session import new_work_path
    from strata.sinks.writers import json_files, write_json
    from strata.streaming.runner import StreamLayout, run_activity_increment
    files = json_files(B.row_count(spark, sf_dir, "events"), 4)
    cfg = QUERY_CFG.with_overrides(max_files_per_trigger=-(-files // 2))
    root = new_work_path(spark, "activity_stream")
    layout = StreamLayout(root)
    raw = B.raw_activity(spark, sf_dir)
    write_json(raw, f"{root}/activity_raw/run1", num_files=files)
    run_activity_increment(spark, cfg, f"{root}/activity_raw/*", layout)
    # Run 2 replays every session (the run-1 lines copied verbatim): the dedup
    # state must reject all of them.
    spark.read.text(f"{root}/activity_raw/run1").write.mode("overwrite").text(f"{root}/activity_raw/run2")
    run_activity_increment(spark, cfg, f"{root}/activity_raw/*", layout)
    out = snapshots.read(spark, layout.table("silver_customer_activity"))
    return public(out.select(*[c for c in _silver_activity(spark, sf_dir).columns]))


SQL_JSON_ROUND_TRIP = ORACLE_RAW_ORDERS

SQL_SAMPLE_BRONZE = f"""SELECT category, CAST(customer_id AS BIGINT) AS customer_id, order_date,
  CAST(order_id AS BIGINT) AS order_id, price, CAST(product_id AS BIGINT) AS product_id, product_name,
  CAST(quantity AS BIGINT) AS quantity, status FROM ({ORACLE_RAW_ORDERS})"""


# ---------------------------------------------------------------- generators (seeded by table keys)

def q_gen_orders(spark, sf_dir):
    """GEN-1, one generated order per key of ``orders``."""
    from strata.sources.synthetic import generate_orders
    return generate_orders(spark, B.table(spark, sf_dir, "orders").select("o_orderkey"), FEATURES_AS_OF)


def q_gen_profiles(spark, sf_dir):
    """GEN-2, one profile per key of ``customer``."""
    from strata.sources.synthetic import generate_customer_profiles
    return generate_customer_profiles(spark, B.table(spark, sf_dir, "customer").select("c_custkey"), FEATURES_AS_OF)


def q_gen_activity(spark, sf_dir):
    """GEN-3, 30 days x up to 8 sessions for every key of ``customer``."""
    from strata.sources.synthetic import generate_customer_activity
    return generate_customer_activity(spark, B.table(spark, sf_dir, "customer").select("c_custkey"),
                                      FEATURES_AS_OF, days_back=30, sessions_per_day=8)


SQL_GEN_ORDERS = gen_orders_sql("SELECT CAST(o_orderkey AS BIGINT) AS order_id FROM orders", FEATURES_AS_OF)
SQL_GEN_PROFILES = gen_profiles_sql("SELECT CAST(c_custkey AS BIGINT) AS customer_id FROM customer",
                                    FEATURES_AS_OF)
SQL_GEN_ACTIVITY = gen_activity_sql("SELECT CAST(c_custkey AS BIGINT) AS customer_id FROM customer",
                                    FEATURES_AS_OF, days_back=30, sessions_per_day=8)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "expect_metrics": q_expect_metrics,
    "expect_metrics_activity": q_expect_metrics_activity,
    "expect_metrics_profiles": q_expect_metrics_profiles,
    "expect_or_drop_orders": q_expect_or_drop_orders,
    "expect_warn_orders": q_expect_warn_orders,
    "expect_or_fail_silver": q_expect_or_fail_silver,
    "silver_orders": q_silver_orders,
    "silver_customers": q_silver_customers,
    "silver_customers_derived": q_silver_customers_derived,
    "gold_daily_sales": q_gold_daily_sales,
    "gold_customer_insights": q_gold_customer_insights,
    "gold_product_performance": q_gold_product_performance,
    "gold_real_time_metrics": q_gold_real_time_metrics,
    "silver_customer_activity": q_silver_customer_activity,
    "silver_customer_profile": q_silver_customer_profile,
    "features_customer_engagement": q_features_customer_engagement,
    "device_pivot": q_device_pivot,
    "features_customer_behavior": q_features_customer_behavior,
    "features_customer_behavior_joined": q_features_customer_behavior_joined,
    "features_customer_locations": q_features_customer_locations,
    "ml_feature_table": q_ml_feature_table,
    "ml_feature_table_joined": q_ml_feature_table_joined,
    "sample_silver_orders": q_sample_silver_orders,
    "sample_silver_customers": q_sample_silver_customers,
    "sample_daily_sales": q_sample_daily_sales,
    "sample_customer_insights": q_sample_customer_insights,
    "sample_product_performance": q_sample_product_performance,
    "top_products": q_top_products,
    "json_round_trip": q_json_round_trip,
    "json_profiles_round_trip": q_json_profiles_round_trip,
    "json_activity_round_trip": q_json_activity_round_trip,
    "sample_bronze_inferred": q_sample_bronze_inferred,
    "stream_silver_orders": q_stream_silver_orders,
    "stream_silver_activity": q_stream_silver_activity,
    "gold_daily_sales_incremental": q_gold_daily_sales_incremental,
    "gen_orders": q_gen_orders,
    "gen_profiles": q_gen_profiles,
    "gen_activity": q_gen_activity,
    **SC.QUERIES,
}

ORACLE: dict[str, str] = {
    "expect_metrics": SQL_EXPECT_METRICS,
    "expect_metrics_activity": SQL_EXPECT_METRICS_ACTIVITY,
    "expect_metrics_profiles": SQL_EXPECT_METRICS_PROFILES,
    "expect_or_drop_orders": SQL_EXPECT_OR_DROP,
    "expect_warn_orders": SQL_EXPECT_WARN,
    "expect_or_fail_silver": SQL_EXPECT_FAIL,
    "silver_orders": SQL_SILVER_ORDERS,
    "silver_customers": SQL_SILVER_CUSTOMERS,
    "silver_customers_derived": SQL_SILVER_CUSTOMERS,
    "gold_daily_sales": SQL_GOLD_DAILY_SALES,
    "gold_customer_insights": SQL_GOLD_CUSTOMER_INSIGHTS,
    "gold_product_performance": SQL_GOLD_PRODUCT_PERFORMANCE,
    "gold_real_time_metrics": SQL_GOLD_REAL_TIME_METRICS,
    "silver_customer_activity": SQL_SILVER_ACTIVITY,
    "silver_customer_profile": SQL_SILVER_PROFILE,
    "features_customer_engagement": SQL_ENGAGEMENT,
    "device_pivot": SQL_DEVICE_PIVOT,
    "features_customer_behavior": SQL_BEHAVIOR,
    "features_customer_behavior_joined": SQL_BEHAVIOR,
    "features_customer_locations": SQL_LOCATIONS,
    "ml_feature_table": SQL_ML_FEATURES,
    "ml_feature_table_joined": SQL_ML_FEATURES,
    "sample_silver_orders": SQL_SAMPLE_SILVER,
    "sample_silver_customers": SQL_SAMPLE_CUSTOMERS,
    "sample_daily_sales": SQL_SAMPLE_DAILY,
    "sample_customer_insights": SQL_SAMPLE_INSIGHTS,
    "sample_product_performance": SQL_SAMPLE_PRODUCTS,
    "top_products": SQL_TOP_PRODUCTS,
    "json_round_trip": SQL_JSON_ROUND_TRIP,
    "json_profiles_round_trip": ORACLE_RAW_PROFILES,
    "json_activity_round_trip": ORACLE_RAW_ACTIVITY,
    "sample_bronze_inferred": SQL_SAMPLE_BRONZE,
    "stream_silver_orders": SQL_SILVER_ORDERS,
    "stream_silver_activity": SQL_SILVER_ACTIVITY,
    "gold_daily_sales_incremental": SQL_GOLD_DAILY_SALES,
    "gen_orders": SQL_GEN_ORDERS,
    "gen_profiles": SQL_GEN_PROFILES,
    "gen_activity": SQL_GEN_ACTIVITY,
    **SC.ORACLE,
    "stream_silver_orders_regrown": SQL_SILVER_ORDERS,
    "stream_silver_orders_compacted": SQL_SILVER_ORDERS,
    "gold_customer_insights_incremental": SQL_GOLD_CUSTOMER_INSIGHTS,
    "silver_customers_incremental": SQL_SILVER_CUSTOMERS,
    "gold_product_performance_incremental": SQL_GOLD_PRODUCT_PERFORMANCE,
}
