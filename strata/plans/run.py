"""Runs of both pipelines: every dataset written as a table.

``run_*_pipeline`` run everything in batch; ``update_*`` are triggered
updates (new files streamed into bronze and silver, then gold in batch:
``gold_daily_sales`` for the months of the new silver batches only, customer and
product tables from partial sums to which the new batches are added);
``record_quality`` appends the run's expectation metrics to a log table.

Silver is materialised once (partitioned Parquet under the shared folder) and
every gold table reads it back: the gold scans share one cleaned, deduplicated
copy instead of recomputing ingest + dedup per table, and the written table
cuts the lineage, so a lost executor only recomputes the stage it was in.
Partition pruning on ``order_date`` serves the rolling-window metrics.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.operators.expectations import check_dataset, metrics_dict
from strata.plans import features as FT
from strata.plans import gold_state as GS
from strata.plans import orders as OR
from strata.plans import sample as SM
from strata.sinks import snapshots
from strata.sinks.writers import clustered, write_table, write_table_info
from strata.streaming.runner import StreamLayout


@dataclass
class RunReport:
    tables: dict[str, str] = field(default_factory=dict)
    expectations: dict[str, dict] = field(default_factory=dict)


# Table descriptions stored with each written table.
COMMENTS = {
    "silver_orders": "Order lines after expectations, one row per (order_id, product_id)",
    "silver_customers": "Per-customer first/latest order, lifetime value and value segment",
    "gold_daily_sales": "Line-item sales per day and category",
    "gold_customer_insights": "Per-customer order behaviour with frequency, value and recency segments",
    "gold_product_performance": "Per-product sales, popularity and price stability",
    "gold_real_time_metrics": "Today's and the trailing 7-day operational figures",
    "bronze_customer_profiles": "Customer profiles as read, with the time of ingestion",
    "sample_silver_orders": "Sample edition: order lines after expectations",
    "sample_silver_customers": "Sample edition: customers",
    "sample_daily_sales": "Sample edition: sales per day and category",
    "sample_customer_insights": "Sample edition: orders and value per customer",
    "sample_product_performance": "Sample edition: units and revenue per product",
    "silver_customer_activity": "Sessions after expectations, one row per (customer_id, session_id)",
    "silver_customer_profile": "Customer profiles with signup age and vintage segment",
    "gold_features_customer_engagement": "Per-customer engagement features",
    "gold_features_customer_behavior": "Per-customer device and location features",
    "gold_ml_feature_table": "Model-ready customer features with churn, value and engagement labels",
}


def _layer(name: str) -> str:
    return name.split("_", 1)[0] if name.split("_", 1)[0] in ("bronze", "silver", "gold") else "internal"


def _write(report: RunReport, layout: StreamLayout, name: str, df: DataFrame, cfg: PipelineConfig,
           partition_cols=(), cluster_cols=()) -> str:
    props = None
    if name in COMMENTS:
        props = cfg.table_properties(_layer(name), list(cluster_cols))
        props["partition_cols"] = ",".join(partition_cols)
    path = write_table(df, layout.table(name), partition_cols, cluster_cols, cfg.target_file_size_bytes,
                       comment=COMMENTS.get(name), properties=props)
    report.tables[name] = path
    return path


def run_orders_pipeline(spark: SparkSession, bronze: DataFrame, cfg: PipelineConfig, layout: StreamLayout,
                        as_of=None) -> RunReport:
    """DS-2..7 from a bronze orders frame (batch)."""
    rep = RunReport()
    silver, metrics = OR.silver_orders(bronze, cfg)
    _write(rep, layout, "silver_orders", silver, cfg, ["order_date"], ["order_date", "order_id", "customer_id"])
    rep.expectations["silver_orders"] = metrics_dict(metrics)
    _orders_gold_from_silver(spark, rep, layout, cfg, as_of)
    return rep


def run_features_pipeline(spark: SparkSession, bronze_activity: DataFrame, bronze_profiles: DataFrame,
                          cfg: PipelineConfig, layout: StreamLayout, as_of=None) -> RunReport:
    """DS-9, 11..14 (batch)."""
    rep = RunReport()
    silver, m1 = FT.silver_customer_activity(bronze_activity, cfg)
    _write(rep, layout, "silver_customer_activity", silver, cfg, ["activity_date"],
           ["customer_id", "activity_date"])
    rep.expectations["silver_customer_activity"] = metrics_dict(m1)
    profile, m2 = FT.silver_customer_profile(_bronze_profiles(spark, rep, layout, cfg, bronze_profiles), cfg, as_of)
    _write(rep, layout, "silver_customer_profile", profile, cfg)
    rep.expectations["silver_customer_profile"] = metrics_dict(m2)
    act = spark.read.parquet(rep.tables["silver_customer_activity"])
    prof = spark.read.parquet(rep.tables["silver_customer_profile"])
    _features_gold(spark, rep, layout, cfg, act, prof, as_of)
    return rep


def _bronze_profiles(spark: SparkSession, rep: RunReport, layout: StreamLayout, cfg: PipelineConfig, bronze: DataFrame) -> DataFrame:
    """DS-10: the profiles as they came, written as a table and read back."""
    return spark.read.parquet(_write(rep, layout, "bronze_customer_profiles", bronze, cfg))


def _features_gold(spark: SparkSession, rep: RunReport, layout: StreamLayout, cfg: PipelineConfig,
                   act: DataFrame, prof: DataFrame, as_of=None) -> None:
    """One aggregation of silver activity by customer (engagement, device
    counts, locations) is written once; the engagement and behaviour tables are
    projections of it and the ML table joins it to the profiles."""
    _write(rep, layout, "_customer_activity_features", FT.customer_activity_aggregate(act, as_of), cfg,
           cluster_cols=["customer_id"])
    feats = spark.read.parquet(rep.tables["_customer_activity_features"])
    _write(rep, layout, "gold_features_customer_engagement", feats.select(*FT.ENGAGEMENT_COLUMNS), cfg)
    _write(rep, layout, "gold_features_customer_behavior", feats.select(*FT.BEHAVIOR_COLUMNS), cfg)
    _write(rep, layout, "gold_ml_feature_table", FT.ml_feature_table(None, prof, as_of, features=feats), cfg)


def _orders_gold_from_silver(spark: SparkSession, rep: RunReport, layout: StreamLayout, cfg: PipelineConfig,
                             as_of=None, incremental: bool = False) -> None:
    s = snapshots.read_table(spark, rep.tables["silver_orders"])
    check_dataset(s, "critical_data_quality", "count(*) > 0")
    # One aggregation of silver by customer serves both customer tables.
    root = layout.table("").rstrip("/")
    for state in GS.STATES if incremental else ():
        GS.update_state(spark, rep.tables["silver_orders"], root, state)
    insights = (GS.customer_insights(spark, root, cfg, as_of) if incremental
                else OR.gold_customer_insights(s, cfg, as_of))
    _write(rep, layout, "gold_customer_insights", insights, cfg, cluster_cols=["customer_id"])
    insights = spark.read.parquet(rep.tables["gold_customer_insights"])
    _write(rep, layout, "silver_customers", OR.silver_customers_from_insights(insights, cfg), cfg)
    if not incremental:
        _write(rep, layout, "gold_daily_sales", OR.gold_daily_sales(s, cfg, ordered=False), cfg,
               ["order_year", "order_month"], ["order_date", "category"])
    products = (GS.product_performance(spark, root, cfg) if incremental
                else OR.gold_product_performance(s, cfg, ordered=False))
    _write(rep, layout, "gold_product_performance", products, cfg, cluster_cols=["category", "total_revenue"])
    _write(rep, layout, "gold_real_time_metrics", OR.gold_real_time_metrics(s, cfg, as_of), cfg)


def update_orders(spark: SparkSession, cfg: PipelineConfig, source_path: str, layout: StreamLayout,
                  as_of=None) -> RunReport:
    """One triggered update (STR-4/STR-6): new JSON files -> bronze -> silver
    (streaming, checkpointed, stateful dedup), then the gold tables in batch
    from the new silver batches: daily sales for the months they touch, the
    customer and product tables by merging their partial sums."""
    from strata.streaming.runner import run_orders_increment
    rep = RunReport()
    inc = run_orders_increment(spark, cfg, source_path, layout)
    rep.expectations["silver_orders"] = inc["expectations"]
    rep.tables["bronze_orders"] = layout.table("bronze_orders")
    rep.tables["silver_orders"] = layout.table("silver_orders")
    _orders_gold_from_silver(spark, rep, layout, cfg, as_of, incremental=True)
    # The date-partitioned gold table is refreshed for the touched months only.
    rep.expectations["gold_daily_sales_refresh"] = refresh_daily_sales(spark, cfg, layout)
    rep.tables["gold_daily_sales"] = layout.table("gold_daily_sales")
    return rep


def update_features(spark: SparkSession, cfg: PipelineConfig, activity_path: str, profiles_path: str,
                    layout: StreamLayout, as_of=None) -> RunReport:
    """Triggered update of the feature pipeline: activity streams into silver;
    profiles (a small batch source) and the three gold tables are recomputed."""
    from strata.sources.readers import bronze_customer_profiles
    from strata.streaming.runner import run_activity_increment
    rep = RunReport()
    inc = run_activity_increment(spark, cfg, activity_path, layout)
    rep.expectations["silver_customer_activity"] = inc["expectations"]
    bronze = _bronze_profiles(spark, rep, layout, cfg, bronze_customer_profiles(spark, cfg, profiles_path))
    profile, m = FT.silver_customer_profile(bronze, cfg, as_of)
    _write(rep, layout, "silver_customer_profile", profile, cfg)
    rep.expectations["silver_customer_profile"] = metrics_dict(m)
    act = snapshots.read_table(spark, layout.table("silver_customer_activity"))
    prof = spark.read.parquet(rep.tables["silver_customer_profile"])
    _features_gold(spark, rep, layout, cfg, act, prof, as_of)
    return rep


def update_sample(spark: SparkSession, cfg: PipelineConfig, source_path: str, layout: StreamLayout, as_of=None) -> RunReport:
    """The sample edition (DS-15..20): new JSON files into a bronze table whose schema is
    inferred and grows, then its other tables in batch."""
    from strata.sources.evolving import read_evolving, run_evolving
    rep = RunReport()
    bronze = (layout.table("sample_bronze_orders"), layout.checkpoint("sample_bronze_orders"))
    run_evolving(spark, source_path, *bronze, cfg.streaming_options())
    rep.tables["sample_bronze_orders"] = bronze[0]
    silver, metrics = SM.sample_silver_orders(read_evolving(spark, *bronze))
    _write(rep, layout, "sample_silver_orders", silver, cfg)
    rep.expectations["sample_silver_orders"] = metrics_dict(metrics)
    silver = spark.read.parquet(rep.tables["sample_silver_orders"])
    _write(rep, layout, "sample_silver_customers", SM.sample_silver_customers(silver, as_of), cfg)
    _write(rep, layout, "sample_daily_sales", SM.sample_daily_sales(silver, ordered=False), cfg, cluster_cols=["order_date", "category"])
    _write(rep, layout, "sample_customer_insights", SM.sample_customer_insights(silver), cfg)
    _write(rep, layout, "sample_product_performance", SM.sample_product_performance(silver), cfg)
    return rep


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table can be read at ``path`` (any file system)."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def refresh_daily_sales(spark: SparkSession, cfg: PipelineConfig, layout: StreamLayout) -> dict:
    """Incremental refresh of ``gold_daily_sales`` (STR-6): the log of silver batches
    tells which were added since the version of the last refresh and which months they
    touch; those (year, month) partitions are recomputed from silver, pruned to them,
    and replaced with a dynamic partition overwrite. Exact, because a month's rows all
    live in silver. The version is written last, so a refresh that failed is repeated."""
    silver_path, gold_path, state_path = (layout.table(t) for t in ("silver_orders", "gold_daily_sales", "_gold_refresh_state"))
    first_run = not (table_exists(spark, state_path) and table_exists(spark, gold_path))
    last = 0 if first_run else spark.read.parquet(state_path).first()["silver_version"]
    version = snapshots.latest_version(spark, silver_path)
    new = [p for p in snapshots.added_since(spark, silver_path, last) if p.added <= version]
    months = sorted({m for p in new for m in p.months})
    if months or first_run:
        silver = snapshots.read(spark, silver_path, version=version)
        if not first_run:  # a filter on the partition column alone: other folders aren't listed
            silver = silver.filter(F.date_format("order_date", "yyyy-MM").isin(months))
        daily = OR.gold_daily_sales(silver, cfg, ordered=False)
        (clustered(daily, ["order_date", "category"], ["order_year", "order_month"])
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if not first_run else "static")
         .partitionBy("order_year", "order_month").parquet(gold_path))
        if first_run:
            props = cfg.table_properties("gold", ["order_date", "category"])
            props["partition_cols"] = "order_year,order_month"
            write_table_info(spark, gold_path, COMMENTS["gold_daily_sales"], props)
    spark.createDataFrame([(version,)], "silver_version long").coalesce(1).write.mode("overwrite").parquet(state_path)
    return {"months": [(int(m[:4]), int(m[5:])) for m in months], "full": first_run}


def record_quality(spark: SparkSession, rep: RunReport, layout: StreamLayout, run_label: str | None = None) -> str:
    """Append this run's expectation metrics to a ``_dq_log`` table (one row per
    dataset and expectation: total, failed, passed), for monitoring over runs.
    The rows are a handful of counters per run, built on the driver."""
    import datetime as _dt

    from pyspark.sql import types as T
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    label = run_label or now.strftime("%Y%m%dT%H%M%S")
    rows = []
    for dataset, m in rep.expectations.items():
        if not isinstance(m, dict) or "total_records" not in m:
            continue
        total = int(m["total_records"])
        for k, v in m.items():
            if k.startswith("failed_"):
                rows.append((label, now, dataset, k[len("failed_"):], total, int(v), total - int(v)))
    schema = T.StructType([T.StructField("run", T.StringType()), T.StructField("recorded_at", T.TimestampNTZType()),
                           T.StructField("dataset", T.StringType()), T.StructField("expectation", T.StringType()),
                           T.StructField("total_records", T.LongType()), T.StructField("failed_records", T.LongType()),
                           T.StructField("passed_records", T.LongType())])
    path = layout.table("_dq_log")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path
