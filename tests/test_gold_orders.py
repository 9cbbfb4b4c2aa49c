import datetime as dt

from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.plans import orders as OR
from strata.plans import sample as SM

CFG = PipelineConfig()
SCHEMA = ("order_id string, customer_id string, order_date date, product_id string, product_name string, "
          "category string, quantity int, price double, total_item_price double")


def silver(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})


D = dt.date


def test_real_time_metrics_empty_input(spark):
    out = OR.gold_real_time_metrics(silver(spark, []), CFG, "2024-01-10").collect()
    assert [r.metric_type for r in out] == ["daily", "7_day_rolling"]
    assert out[0].todays_orders == 0 and out[0].todays_revenue is None and out[0].orders_7d is None
    assert out[1].orders_7d == 0 and out[1].revenue_7d is None and out[1].todays_orders is None
    assert out[0].metric_date == D(2024, 1, 10)


def test_real_time_metrics_windows(spark):
    rows = [("o1", "c1", D(2024, 1, 10), "p", "n", "c", 1, 2.0, 2.0),
            ("o2", "c2", D(2024, 1, 3), "p", "n", "c", 1, 4.0, 4.0),   # 7 days ago: inclusive
            ("o3", "c2", D(2024, 1, 2), "p", "n", "c", 1, 8.0, 8.0),   # 8 days ago: out
            ("o4", "c3", D(2024, 1, 20), "p", "n", "c", 1, 16.0, 16.0)]  # future: in the 7-day row
    daily, rolling = OR.gold_real_time_metrics(silver(spark, rows), CFG, "2024-01-10").collect()
    assert (daily.todays_orders, daily.todays_revenue, daily.todays_customers) == (1, 2.0, 1)
    assert (rolling.orders_7d, rolling.revenue_7d, rolling.customers_7d) == (3, 22.0, 3)


def test_daily_sales_and_customer_insights(spark):
    rows = [("o1", "c1", D(2024, 1, 1), "p1", "n", "A", 2, 10.0, 20.0),
            ("o1", "c1", D(2024, 1, 1), "p2", "n", "A", 1, 30.0, 30.0),
            ("o2", "c2", D(2024, 1, 1), "p1", "n", "A", 1, 10.0, 10.0),
            ("o3", "c1", D(2024, 1, 11), "p1", "n", "B", 3, 10.0, 30.0)]
    s = silver(spark, rows)
    ds = {(r.order_date, r.category): r for r in OR.gold_daily_sales(s, CFG).collect()}
    a = ds[(D(2024, 1, 1), "A")]
    assert (a.total_orders, a.unique_customers, a.total_items_sold, a.total_revenue) == (2, 2, 4, 60.0)
    assert a.revenue_per_customer == 30.0 and a.items_per_customer == 2.0
    assert a.avg_order_value == 20.0 and a.order_value_stddev == 10.0
    ci = {r.customer_id: r for r in OR.gold_customer_insights(s, CFG, "2024-01-31").collect()}
    c1 = ci["c1"]
    assert (c1.total_orders, c1.unique_products_purchased, c1.categories_shopped) == (2, 2, 2)
    assert c1.customer_tenure_days == 10 and c1.avg_days_between_orders == 10.0
    assert c1.days_since_last_order == 20 and c1.customer_recency_segment == "Recent"
    assert c1.customer_frequency_segment == "Occasional" and ci["c2"].avg_days_between_orders is None
    sc = {r.customer_id: r for r in OR.silver_customers(s, CFG).collect()}
    assert sc["c1"].total_items_purchased == 3 and sc["c1"].customer_segment == "Basic"


def test_product_performance(spark):
    rows = [("o1", "c1", D(2024, 1, 1), "p1", "n", "A", 2, 10.0, 20.0),
            ("o2", "c2", D(2024, 1, 5), "p1", "n", "A", 1, 12.0, 12.0)]
    (r,) = OR.gold_product_performance(silver(spark, rows), CFG).collect()
    assert r.unique_customers == 2 and r.unique_orders == 2 and r.product_lifecycle_days == 4
    assert r.price_stability == "Medium Variance" and r.product_popularity_score == 0.03
    assert r.revenue_per_customer == 16.0


def test_sorted_outputs(spark):
    rows = [("o%d" % i, "c", D(2024, 1, 1 + i % 3), "p%d" % (i % 4), "n", "AB"[i % 2], 1, float(i), float(i))
            for i in range(20)]
    ds = OR.gold_daily_sales(silver(spark, rows), CFG).collect()
    assert [(r.order_date, r.category) for r in ds] == sorted((r.order_date, r.category) for r in ds)
    pp = OR.gold_product_performance(silver(spark, rows), CFG).collect()
    assert [r.total_revenue for r in pp] == sorted((r.total_revenue for r in pp), reverse=True)


def test_sample_edition(spark):
    bronze = spark.createDataFrame(
        [("A", 1, "2024-01-01", 1, 2.5, 1, "x", 2, None), ("A", 1, "bad", 2, 2.5, 1, "x", 2, "s"),
         ("A", 2, "2024-01-01", 3, 2.5, None, "x", 2, "s"), ("A", 2, "2024-01-01", 4, 2.5, 2, "y", 0, "s"),
         ("B", 2, "2024-01-02", 5, 1.25, 2, "y", 3, "s")],
        "category string, customer_id long, order_date string, order_id long, price double, product_id long, "
        "product_name string, quantity long, status string")
    s, obs = SM.sample_silver_orders(bronze)
    rows = s.collect()
    assert sorted(r.order_id for r in rows) == [1, 5]
    assert {r.order_id: r.status for r in rows}[1] == "unknown"
    assert obs.get["failed_valid_quantity"] == 1
    assert sorted(r.customer_id for r in SM.sample_silver_customers(s, "2024-01-03").collect()) == [1, 2]
    assert SM.sample_daily_sales(s).count() == 2
    assert {r.customer_id: r.lifetime_value for r in SM.sample_customer_insights(s).collect()} == {1: 5.0, 2: 3.75}
    assert [r.product_id for r in SM.sample_product_performance(s).collect()] == [1, 2]


def test_single_row_group_stddev_is_null(spark):
    rows = [("o1", "c1", D(2024, 1, 1), "p1", "n", "A", 2, 10.0, 20.0)]
    (r,) = OR.gold_daily_sales(silver(spark, rows), CFG).collect()
    assert r.order_value_stddev is None and r.avg_order_value == 20.0


def test_silver_customers_from_insights_equals_direct(spark):
    rows = [("o1", "c1", D(2024, 1, 1), "p1", "n", "A", 2, 10.0, 20.0),
            ("o1", "c1", D(2024, 1, 1), "p2", "n", "A", 1, 30.0, 30.0),
            ("o2", "c2", D(2024, 1, 1), "p1", "n", "A", 1, 10.0, 10.0),
            ("o3", "c1", D(2024, 1, 11), "p1", "n", "B", 3, 10.0, 30.0),
            ("o4", None, D(2024, 1, 12), "p1", "n", "B", 3, 10.0, 30.0)]
    s = silver(spark, rows)
    direct = OR.silver_customers(s, CFG).drop("updated_timestamp")
    derived = OR.silver_customers_from_insights(OR.gold_customer_insights(s, CFG, "2024-02-01"), CFG)
    assert sorted(direct.collect()) == sorted(derived.drop("updated_timestamp").collect())
    assert direct.columns == derived.drop("updated_timestamp").columns
