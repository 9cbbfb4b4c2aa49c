"""Feature pipeline on hand-made activity and profile rows."""

import json

from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.plans import features as FT
from strata.sources.readers import bronze_customer_activity, bronze_customer_profiles

CFG = PipelineConfig()
AS_OF = "2024-02-13"


def act(cid, ts, sid, device="mobile", loc="A", pv=3, ca=1, pu=0):
    return json.dumps({"customer_id": cid, "timestamp": ts, "page_views": pv, "cart_adds": ca,
                       "purchases": pu, "device": device, "location": loc, "session_id": sid})


def silver(spark, json_dir, lines):
    bronze = bronze_customer_activity(spark, CFG, json_dir(lines), stream=False)
    return FT.silver_customer_activity(bronze, CFG)


def test_activity_expectations(spark, json_dir):
    lines = [act(1, "2024-01-06T10:00:00", "s1", pv=0), act(1, "2024-01-06T11:00:00", "s2", pv=-1),
             json.dumps({"customer_id": 1, "timestamp": "2024-01-06T12:00:00", "session_id": "s3",
                         "cart_adds": 0, "purchases": 0}),
             act(None, "2024-01-06T10:00:00", "s4"), act(2, "invalid-timestamp", "s5")]
    df, obs = silver(spark, json_dir, lines)
    rows = df.collect()
    assert [r.session_id for r in rows] == ["s1"]
    r = rows[0]
    assert r.is_weekend is True and r.activity_hour == 10 and r.engagement_score == 5
    assert obs.get["failed_valid_page_views"] == 2  # -1 and NULL


def test_session_dedup(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-01-06T10:00:00", "s1"), act(1, "2024-01-06T10:00:00", "s1"),
                                     act(2, "2024-01-06T10:00:00", "s1")])
    assert df.count() == 2


def test_single_day_consistency_is_null(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-01-06T10:00:00", "s1"), act(1, "2024-01-06T18:00:00", "s2")])
    r = FT.gold_features_customer_engagement(df, AS_OF).first()
    assert r.activity_consistency_score is None
    assert r.active_days == 1 and r.total_sessions == 2 and r.weekend_activity_days == 1
    assert r.days_since_last_activity == 38


def test_other_devices_kept_with_zeros(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-01-06T10:00:00", "s1", device="tv"),
                                     json.dumps({"customer_id": 2, "timestamp": "2024-01-06T10:00:00",
                                                 "session_id": "s2", "page_views": 1, "cart_adds": 0,
                                                 "purchases": 0})])
    for fused in (True, False):
        rows = {r.customer_id: r for r in FT.gold_features_customer_behavior(df, fused=fused).collect()}
        assert set(rows) == {1, 2}
        for r in rows.values():
            assert (r.desktop_sessions, r.mobile_sessions, r.tablet_sessions) == (0, 0, 0)
            assert r.device_total_sessions == 0 and r.mobile_preference_score == 0.0
            assert r.multi_device_user is False
    piv = {r.customer_id: r for r in FT.device_pivot(df).collect()}
    assert piv[1].desktop_sessions == 0


def test_fused_equals_joined_form(spark, json_dir):
    lines = [act(c, f"2024-01-0{d}T1{d}:00:00", f"s{c}{d}", device=dev, loc=f"L{d % 3}")
             for c in (1, 2, 3) for d, dev in zip(range(1, 8), ["mobile", "desktop", "tablet"] * 3)]
    df, _ = silver(spark, json_dir, lines)
    a = sorted(FT.gold_features_customer_behavior(df, fused=True).collect())
    b = sorted(FT.gold_features_customer_behavior(df, fused=False).collect())
    assert a == b


def test_ml_table_profile_join_and_veteran(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-02-10T10:00:00", "s1", pu=1),
                                     act(2, "2024-02-10T10:00:00", "s2")])
    prof = bronze_customer_profiles(spark, CFG, json_dir([
        json.dumps({"customer_id": 1, "signup_date": "x", "age_group": "a", "gender": "F",
                    "income_bracket": "b", "loyalty_tier": "t"})]))
    sp, _ = FT.silver_customer_profile(prof, CFG, AS_OF)
    rows = {r.customer_id: r for r in FT.ml_feature_table(df, sp, AS_OF).collect()}
    assert rows[1].customer_vintage_segment == "Veteran" and rows[1].days_since_signup is None
    assert rows[2].age_group is None and rows[2].customer_vintage_segment is None
    assert rows[1].churn_risk_score == "low"  # 3 days since, avg engagement 18
    assert rows[2].churn_risk_score == "low"  # avg engagement exactly 8 is not < 8
    assert len(FT.ML_FEATURE_COLUMNS) == 33


def test_ml_table_precomputed_inputs_equal_fused(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(c, f"2024-02-0{d}T10:00:00", f"s{c}{d}") for c in (1, 2) for d in (1, 5)])
    prof = spark.createDataFrame([(1, "2023-01-01", "a", "F", "b", "t")],
                                 "customer_id int, signup_date string, age_group string, gender string, "
                                 "income_bracket string, loyalty_tier string")
    sp, _ = FT.silver_customer_profile(prof, CFG, AS_OF)
    fused = FT.ml_feature_table(df, sp, AS_OF).drop("feature_timestamp")
    joined = FT.ml_feature_table(df, sp, AS_OF, FT.gold_features_customer_engagement(df, AS_OF),
                                 FT.gold_features_customer_behavior(df)).drop("feature_timestamp")
    assert sorted(fused.collect()) == sorted(joined.collect())


def test_collect_set_option(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-01-06T10:00:00", "s1", loc="A"),
                                     act(1, "2024-01-07T10:00:00", "s2", loc="B")])
    r = FT.gold_features_customer_behavior(df, keep_locations=True).first()
    assert sorted(r.locations_visited) == ["A", "B"] and r.unique_locations == 2
    assert "locations_visited" not in FT.gold_features_customer_behavior(df).columns
    assert F is not None


def test_repeated_profile_repeats_the_row(spark, json_dir):
    df, _ = silver(spark, json_dir, [act(1, "2024-02-10T10:00:00", "s1")])
    prof = spark.createDataFrame([(1, "2023-01-01", "a", "F", "b", "t"), (1, "2023-06-01", "a", "F", "b", "t")],
                                 "customer_id int, signup_date string, age_group string, gender string, "
                                 "income_bracket string, loyalty_tier string")
    sp, _ = FT.silver_customer_profile(prof, CFG, AS_OF)
    assert FT.ml_feature_table(df, sp, AS_OF).count() == 2


def test_projections_of_the_fused_aggregate_equal_the_tables(spark, json_dir):
    lines = [act(c, f"2024-02-0{d}T1{d}:00:00", f"s{c}{d}", device=dev, loc=f"L{d % 3}", pu=d % 2)
             for c in (1, 2, 3) for d, dev in zip(range(1, 8), ["mobile", "desktop", "tablet"] * 3)]
    df, _ = silver(spark, json_dir, lines)
    feats = FT.customer_activity_aggregate(df, AS_OF)
    assert sorted(feats.select(*FT.ENGAGEMENT_COLUMNS).collect()) == \
        sorted(FT.gold_features_customer_engagement(df, AS_OF).collect())
    assert sorted(feats.select(*FT.BEHAVIOR_COLUMNS).collect()) == \
        sorted(FT.gold_features_customer_behavior(df).collect())


def test_multi_device_bound(spark, json_dir):
    lines = [act(1, "2024-01-06T10:00:00", "a", device="mobile"), act(1, "2024-01-06T11:00:00", "b", device="mobile"),
             act(2, "2024-01-06T10:00:00", "c", device="mobile"), act(2, "2024-01-06T11:00:00", "d", device="tablet"),
             act(3, "2024-01-06T10:00:00", "e", device="desktop"), act(3, "2024-01-06T11:00:00", "f", device="tablet"),
             act(3, "2024-01-06T12:00:00", "g", device="mobile")]
    df, _ = silver(spark, json_dir, lines)
    rows = {r.customer_id: r for r in FT.gold_features_customer_behavior(df).collect()}
    assert [rows[c].multi_device_user for c in (1, 2, 3)] == [False, True, True]
    assert rows[3].device_total_sessions == 3 and rows[3].desktop_preference_score == 0.333
    assert rows[2].mobile_preference_score == 0.5
