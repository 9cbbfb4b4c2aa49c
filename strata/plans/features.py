"""Feature pipeline: DS-9 silver activity, DS-11 silver profile, DS-12..14 gold.

``customer_activity_aggregate`` computes every per-customer figure the three
gold feature tables need in ONE grouped aggregate over silver activity:
engagement metrics, device counts (the pivot as conditional counts) and
location diversity. The engagement and behaviour tables are projections of it,
and the ML table joins it once to the profiles — one shuffle of the activity
rows instead of four aggregates, a pivot and two joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.functions import dates as D
from strata.functions import segments as S
from strata.operators.dedup import ORDERED, dedup
from strata.operators.distinct import agg_with_distinct
from strata.operators.expectations import (SILVER_ACTIVITY_EXPECTATIONS, SILVER_PROFILE_EXPECTATIONS,
                                           apply_expectations)
from strata.operators.pivot import conditional_count_columns, pivot_counts

ACTIVITY_KEYS = ["customer_id", "session_id"]
ACTIVITY_DEDUP_ORDER = ["timestamp", "page_views", "cart_adds", "purchases", "device", "location"]
# The pivoted device classes.
DEVICES = ["desktop", "mobile", "tablet"]


def clean_activity(bronze: DataFrame) -> DataFrame:
    """Stateless row work of silver activity (FN-2, FN-3, FN-4, FN-6, SEG-8)."""
    if "source_file" not in bronze.columns:
        bronze = bronze.withColumn("source_file", F.lit(None).cast("string"))
    ad = F.col("activity_date")
    return (bronze
            .withColumn("activity_date", D.date_of("timestamp"))
            .withColumns({
                "activity_hour": D.hour_of("timestamp"),
                "is_weekend": D.is_weekend(ad),
                "engagement_score": S.engagement_score(),
                "processed_timestamp": F.current_timestamp(),
                "activity_year": F.year(ad),
                "activity_month": F.month(ad),
            }))


def silver_customer_activity(bronze: DataFrame, cfg: PipelineConfig, dedup_mode: str = ORDERED,
                             watermark: bool = True, observe: bool = True):
    """DS-9. Returns ``(df, metrics)``."""
    df = bronze
    if watermark and df.isStreaming:
        df = df.withWatermark("ingestion_timestamp", cfg.watermark_delay)
    # Derived columns depend on the row only, so they follow the dedup shuffle.
    df = clean_activity(dedup(df, ACTIVITY_KEYS, dedup_mode, ACTIVITY_DEDUP_ORDER))
    return apply_expectations(df, SILVER_ACTIVITY_EXPECTATIONS, "silver_customer_activity", observe)


def silver_customer_profile(bronze: DataFrame, cfg: PipelineConfig, as_of=None, observe: bool = True):
    """DS-11. Returns ``(df, metrics)``."""
    df = (bronze
          .withColumn("signup_date_parsed", D.parse_date("signup_date"))
          .withColumn("days_since_signup", D.days_since("signup_date_parsed", as_of))
          .withColumn("customer_vintage_segment", S.vintage_segment())
          .withColumn("processed_timestamp", F.current_timestamp()))
    return apply_expectations(df, SILVER_PROFILE_EXPECTATIONS, "silver_customer_profile", observe)


def _engagement_aggs():
    return [
        F.sum("page_views").alias("total_page_views"),
        F.sum("cart_adds").alias("total_cart_adds"),
        F.sum("purchases").alias("total_purchases"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.max("engagement_score").alias("max_engagement_score"),
        F.stddev_samp("engagement_score").alias("engagement_score_stddev"),
        F.max("activity_date").alias("last_activity_date"),
        F.min("activity_date").alias("first_activity_date"),
        F.approx_count_distinct(F.when(F.col("is_weekend"), F.col("activity_date")))
         .alias("weekend_activity_days"),
        F.avg("activity_hour").alias("avg_activity_hour"),
    ]


_ENGAGEMENT_DISTINCT = {"active_days": "activity_date", "total_sessions": "session_id"}
_BEHAVIOR_DISTINCT = {"unique_locations": "location"}


def _engagement_derived(df: DataFrame, as_of) -> DataFrame:
    return (df
            .withColumn("avg_page_views_per_session", S.per_unit("total_page_views", "total_sessions"))
            .withColumn("conversion_rate_cart_to_purchase", S.guarded_rate("total_purchases", "total_cart_adds"))
            .withColumn("days_since_last_activity", D.days_since("last_activity_date", as_of))
            .withColumn("activity_consistency_score", S.consistency_score()))


ENGAGEMENT_COLUMNS = [
    "customer_id", "total_page_views", "total_cart_adds", "total_purchases", "avg_engagement_score",
    "max_engagement_score", "engagement_score_stddev", "last_activity_date", "first_activity_date",
    "active_days", "total_sessions", "weekend_activity_days", "avg_activity_hour",
    "avg_page_views_per_session", "conversion_rate_cart_to_purchase", "days_since_last_activity",
    "activity_consistency_score",
]

BEHAVIOR_COLUMNS = [
    "customer_id", "desktop_sessions", "mobile_sessions", "tablet_sessions", "unique_locations",
    "device_total_sessions", "mobile_preference_score", "desktop_preference_score", "multi_device_user",
]


def _behavior_derived(df: DataFrame) -> DataFrame:
    ds, ms, ts = (F.coalesce(F.col(f"{d}_sessions"), F.lit(0)) for d in DEVICES)
    return (df
            .withColumn("device_total_sessions", ds + ms + ts)
            .withColumn("mobile_preference_score", S.guarded_rate(ms, "device_total_sessions"))
            .withColumn("desktop_preference_score", S.guarded_rate(ds, "device_total_sessions"))
            .withColumn("multi_device_user",
                        ((ds > 0).cast("int") + (ms > 0).cast("int") + (ts > 0).cast("int")) >= 2))


def customer_activity_aggregate(silver: DataFrame, as_of=None, keep_locations: bool = False) -> DataFrame:
    """All per-customer activity figures in one grouped aggregate."""
    aggs = _engagement_aggs() + conditional_count_columns("device", DEVICES, "_sessions")
    if keep_locations:
        aggs.append(F.collect_set("location").alias("locations_visited"))
    df = agg_with_distinct(silver, ["customer_id"], aggs, _ENGAGEMENT_DISTINCT | _BEHAVIOR_DISTINCT)
    return _behavior_derived(_engagement_derived(df, as_of))


def gold_features_customer_engagement(silver: DataFrame, as_of=None) -> DataFrame:
    """DS-12."""
    df = agg_with_distinct(silver, ["customer_id"], _engagement_aggs(), _ENGAGEMENT_DISTINCT)
    return _engagement_derived(df, as_of).select(*ENGAGEMENT_COLUMNS)


def device_pivot(silver: DataFrame) -> DataFrame:
    """AGG-9 in its two-level form: sessions per device class, zero-filled."""
    return pivot_counts(silver, "customer_id", "device", DEVICES, suffix="_sessions")


def gold_features_customer_behavior(silver: DataFrame, fused: bool = True,
                                    keep_locations: bool = False) -> DataFrame:
    """DS-13. ``fused`` = one aggregate; otherwise pivot ⋈ location aggregate (JOIN-1)."""
    if fused:
        aggs = conditional_count_columns("device", DEVICES, "_sessions") + [
            F.count_distinct("location").alias("unique_locations")]
        if keep_locations:
            aggs.append(F.collect_set("location").alias("locations_visited"))
        df = silver.groupBy("customer_id").agg(*aggs)
    else:
        loc_aggs = [F.count_distinct("location").alias("unique_locations")]
        if keep_locations:
            loc_aggs.append(F.collect_set("location").alias("locations_visited"))
        locations = silver.groupBy("customer_id").agg(*loc_aggs)
        df = device_pivot(silver).join(locations, "customer_id", "inner")
    cols = BEHAVIOR_COLUMNS + (["locations_visited"] if keep_locations else [])
    return _behavior_derived(df).select(*cols)


ML_FEATURE_COLUMNS = [
    "customer_id", "feature_timestamp",
    "total_page_views", "total_cart_adds", "total_purchases",
    "avg_engagement_score", "max_engagement_score", "engagement_score_stddev",
    "active_days", "total_sessions", "weekend_activity_days",
    "avg_page_views_per_session", "conversion_rate_cart_to_purchase",
    "days_since_last_activity", "activity_consistency_score", "avg_activity_hour",
    "desktop_sessions", "mobile_sessions", "tablet_sessions", "device_total_sessions",
    "mobile_preference_score", "desktop_preference_score",
    "multi_device_user", "unique_locations",
    "age_group", "gender", "income_bracket", "loyalty_tier",
    "days_since_signup", "customer_vintage_segment",
    "churn_risk_score", "customer_value_segment", "engagement_level",
]

_PROFILE_FEATURES = ["customer_id", "age_group", "gender", "income_bracket", "loyalty_tier",
                     "days_since_signup", "customer_vintage_segment"]


def ml_feature_table(silver_activity: DataFrame | None, silver_profile: DataFrame, as_of=None,
                     engagement: DataFrame | None = None, behavior: DataFrame | None = None,
                     features: DataFrame | None = None) -> DataFrame:
    """DS-14: engagement ⟕ behaviour ⟕ profile, with churn/value/engagement labels.

    ``features`` may be a written ``customer_activity_aggregate``. Without
    precomputed inputs the engagement and behaviour sides come from one aggregate (they share the key and the customer set, so the left join
    between them is 1:1). The profile join (JOIN-3) is a left equi-join; Spark
    broadcasts the profile side only when its measured size is under the
    broadcast threshold and otherwise shuffles both sides on customer_id.
    Profiles are not deduplicated, so a repeated profile repeats the row.
    """
    if features is None:
        if engagement is None or behavior is None:
            features = customer_activity_aggregate(silver_activity, as_of)
        else:
            features = engagement.join(behavior, "customer_id", "left")
    profile = silver_profile.select(*_PROFILE_FEATURES)
    return (features.join(profile, "customer_id", "left")
            .withColumn("feature_timestamp", F.current_timestamp())
            .withColumn("churn_risk_score", S.churn_risk())
            .withColumn("customer_value_segment", S.purchase_value_segment())
            .withColumn("engagement_level", S.engagement_level())
            .select(*ML_FEATURE_COLUMNS))
