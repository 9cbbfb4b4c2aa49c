"""GEN-1..3: partition-independent, defect rates near the documented ones, end-to-end run."""

from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.sources.synthetic import generate_customer_activity, generate_customer_profiles, generate_orders

AS_OF = "2024-02-13"


def test_orders_independent_of_partitioning(spark):
    a = generate_orders(spark, 300, AS_OF)
    b = generate_orders(spark, spark.range(1, 301).repartition(7), AS_OF)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_orders_shape(spark):
    df = generate_orders(spark, 4000, AS_OF).cache()
    per_order = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"),
                                           F.count_distinct("product_name").alias("d"))
    assert per_order.filter("n < 1 OR n > 3 OR n != d").count() == 0  # 1-3 distinct products
    n = df.count()
    bad_dates = df.select("order_id", "order_date").distinct().filter("order_date = 'invalid-date'").count()
    assert 0.03 < bad_dates / 4000 < 0.07
    assert 0.015 < df.filter("product_id IS NULL").count() / n < 0.045
    assert df.agg(F.min("quantity"), F.max("quantity"), F.min("customer_id"), F.max("customer_id")).first() == \
        (1, 5, 1, 100)
    dates = df.filter("order_date != 'invalid-date'").agg(F.min("order_date"), F.max("order_date")).first()
    assert tuple(dates) == ("2024-01-14", AS_OF)  # 0..30 days back
    df.unpersist()


def test_profiles(spark):
    df = generate_customer_profiles(spark, 500, AS_OF)
    r = df.agg(F.min("signup_date"), F.max("signup_date"), F.count_distinct("age_group")).first()
    assert r[0] >= "2021-02-13" and r[1] <= "2023-08-17" and r[2] == 6


def test_activity(spark):
    df = generate_customer_activity(spark, 60, AS_OF, days_back=30, sessions_per_day=8).cache()
    n = df.count()
    assert 60 * 30 * 0.6 * 1 < n < 60 * 30 * 0.8 * 8
    assert df.select("session_id").distinct().count() == n
    nulls = df.filter("customer_id IS NULL").count()
    assert 0 < nulls < 0.04 * n  # only the defect row itself, not the customer's later rows
    ok = df.filter("page_views >= 0 AND timestamp != 'invalid-timestamp'")
    assert ok.agg(F.min("page_views"), F.max("page_views")).first()[0] >= 1
    assert ok.filter("purchases > cart_adds").count() == 0
    assert ok.filter("substr(timestamp, 12, 2) < '08'").count() == 0
    df.unpersist()


def test_generated_data_through_both_pipelines(spark, tmp_path):
    from strata.plans.run import run_features_pipeline, run_orders_pipeline
    from strata.sinks.writers import write_json
    from strata.sources.readers import bronze_customer_activity, bronze_customer_profiles, bronze_orders
    from strata.streaming.runner import StreamLayout
    cfg = PipelineConfig(base_path=str(tmp_path / "data"))
    write_json(generate_orders(spark, 500, AS_OF), cfg.orders_source_path)
    write_json(generate_customer_profiles(spark, 100, AS_OF), cfg.profiles_source_path)
    write_json(generate_customer_activity(spark, 100, AS_OF, 30, 8), cfg.activity_source_path)
    lay = StreamLayout(str(tmp_path / "tables"))
    rep = run_orders_pipeline(spark, bronze_orders(spark, cfg, stream=False), cfg, lay, AS_OF)
    m = rep.expectations["silver_orders"]
    assert m["failed_valid_order_date"] > 0 and m["failed_valid_product_id"] > 0
    from strata.sinks.writers import table_info
    info = table_info(spark, rep.tables["gold_daily_sales"])
    assert info["properties"]["quality"] == "gold" and info["properties"]["partition_cols"] == "order_year,order_month"
    assert table_info(spark, rep.tables["silver_orders"])["comment"].startswith("Order lines")
    gold = spark.read.parquet(rep.tables["gold_real_time_metrics"]).collect()
    assert {r.metric_type for r in gold} == {"daily", "7_day_rolling"}
    rep2 = run_features_pipeline(spark, bronze_customer_activity(spark, cfg, stream=False),
                                 bronze_customer_profiles(spark, cfg), cfg, lay, AS_OF)
    ml = spark.read.parquet(rep2.tables["gold_ml_feature_table"])
    assert ml.count() == 100 and len(ml.columns) == 33
    assert rep2.expectations["silver_customer_activity"]["failed_valid_customer_id"] > 0


def test_triggered_updates_end_to_end(spark, tmp_path):
    """Trace C: generate -> JSON -> streaming bronze/silver -> batch gold, run twice."""
    from strata.plans.run import update_features, update_orders
    from strata.sinks.writers import write_json
    from strata.streaming.runner import StreamLayout
    cfg = PipelineConfig(base_path=str(tmp_path / "data"), max_files_per_trigger=2)
    write_json(generate_orders(spark, 300, AS_OF), cfg.orders_source_path + "/day1", num_files=3)
    write_json(generate_customer_profiles(spark, 50, AS_OF), cfg.profiles_source_path)
    write_json(generate_customer_activity(spark, 50, AS_OF, 10, 4), cfg.activity_source_path + "/day1")
    lay = StreamLayout(str(tmp_path / "tables"))
    r1 = update_orders(spark, cfg, cfg.orders_source_path + "/*", lay, AS_OF)
    n1 = spark.read.parquet(r1.tables["silver_orders"]).count()
    write_json(generate_orders(spark, spark.range(301, 401), AS_OF), cfg.orders_source_path + "/day2")
    r2 = update_orders(spark, cfg, cfg.orders_source_path + "/*", lay, AS_OF)
    from strata.sinks.writers import table_info
    assert table_info(spark, r2.tables["gold_daily_sales"])["properties"]["quality"] == "gold"
    n2 = spark.read.parquet(r2.tables["silver_orders"]).count()
    assert 0 < n1 < n2
    daily = spark.read.parquet(r2.tables["gold_daily_sales"])
    assert daily.agg(F.sum("total_items_sold")).first()[0] == \
        spark.read.parquet(r2.tables["silver_orders"]).agg(F.sum("quantity")).first()[0]
    rf = update_features(spark, cfg, cfg.activity_source_path + "/*", cfg.profiles_source_path, lay, AS_OF)
    assert spark.read.parquet(rf.tables["gold_ml_feature_table"]).count() == 50


def test_incremental_daily_sales_refresh(spark, tmp_path):
    """Only months with new rows are recomputed, and the result equals a full recompute."""
    import json as _json
    from strata.plans import orders as OR
    from strata.plans.run import refresh_daily_sales
    from strata.streaming.runner import StreamLayout, run_orders_increment
    cfg = PipelineConfig(base_path=str(tmp_path / "data"))
    src = tmp_path / "data" / "orders_raw"

    def put(name, rows):
        d = src / name
        d.mkdir(parents=True)
        (d / "part-0.json").write_text("\n".join(_json.dumps(r) for r in rows) + "\n")

    def order(oid, date, q=1):
        return {"order_id": oid, "customer_id": "c", "order_date": date, "product_id": "p", "product_name": "n",
                "category": "k", "quantity": q, "price": 5.0, "status": "s"}

    lay = StreamLayout(str(tmp_path / "lake"))
    put("a", [order("1", "2024-01-05"), order("2", "2024-02-07"), order("3", "2024-03-09")])
    run_orders_increment(spark, cfg, f"{src}/*", lay)
    r1 = refresh_daily_sales(spark, cfg, lay)
    assert r1["full"]
    put("b", [order("4", "2024-02-07", 4)])
    run_orders_increment(spark, cfg, f"{src}/*", lay)
    r2 = refresh_daily_sales(spark, cfg, lay)
    assert r2 == {"months": [(2024, 2)], "full": False}
    r3 = refresh_daily_sales(spark, cfg, lay)
    assert r3["months"] == []
    assert refresh_daily_sales(spark, cfg, lay) == {"months": [], "full": False}  # mark kept
    got = spark.read.parquet(lay.table("gold_daily_sales"))
    want = OR.gold_daily_sales(spark.read.parquet(lay.table("silver_orders")), cfg, ordered=False)
    cols = ["order_date", "category", "total_orders", "total_items_sold", "total_revenue"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
    feb = got.filter("order_month = 2").first()
    assert feb.total_items_sold == 5 and feb.total_orders == 2


def test_quality_log_over_runs(spark, tmp_path):
    from strata.plans.run import RunReport, record_quality
    from strata.streaming.runner import StreamLayout
    lay = StreamLayout(str(tmp_path / "lake"))
    rep = RunReport(expectations={"silver_orders": {"total_records": 10, "failed_valid_price": 2,
                                                    "failed_valid_quantity": 0}})
    record_quality(spark, rep, lay, "run1")
    p = record_quality(spark, rep, lay, "run2")
    log = spark.read.parquet(p)
    assert log.count() == 4
    r = log.filter("run = 'run2' AND expectation = 'valid_price'").first()
    assert (r.total_records, r.failed_records, r.passed_records) == (10, 2, 8)


def test_feature_updates_pick_up_new_activity(spark, tmp_path):
    from strata.plans.run import update_features
    from strata.sinks.writers import write_json
    from strata.streaming.runner import StreamLayout
    cfg = PipelineConfig(base_path=str(tmp_path / "data"))
    write_json(generate_customer_profiles(spark, 20, AS_OF), cfg.profiles_source_path)
    act = generate_customer_activity(spark, 20, AS_OF, 10, 4).cache()
    write_json(act.filter("customer_id <= 10 OR customer_id IS NULL"), cfg.activity_source_path + "/d1")
    lay = StreamLayout(str(tmp_path / "lake"))
    r1 = update_features(spark, cfg, cfg.activity_source_path + "/*", cfg.profiles_source_path, lay, AS_OF)
    n1 = spark.read.parquet(r1.tables["gold_ml_feature_table"]).count()
    write_json(act.filter("customer_id > 10"), cfg.activity_source_path + "/d2")
    write_json(act.filter("customer_id <= 3"), cfg.activity_source_path + "/d3")  # replayed sessions
    r2 = update_features(spark, cfg, cfg.activity_source_path + "/*", cfg.profiles_source_path, lay, AS_OF)
    ml = spark.read.parquet(r2.tables["gold_ml_feature_table"])
    assert n1 == 10 and ml.count() == 20
    silver = spark.read.parquet(lay.table("silver_customer_activity"))
    assert silver.groupBy("customer_id", "session_id").count().filter("count > 1").count() == 0
    act.unpersist()


def test_activity_of_many_days_and_sessions(spark):
    rows = generate_customer_activity(spark, 2, AS_OF, days_back=1500, sessions_per_day=40)
    got = rows.agg(F.count("*"), F.count_distinct("session_id"), F.min("timestamp")).first()
    assert got[0] == got[1] > 2 * 1500 * 0.6 * 10 and got[2] < "2021"
