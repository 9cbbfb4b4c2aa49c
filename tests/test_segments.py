"""Every CASE chain at, below and above each threshold, and with NULL."""

import pytest
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.functions import segments as S

CFG = PipelineConfig()


def evaluate(spark, column, values, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r.o for r in df.select(column(F.col("v")).alias("o")).collect()]


@pytest.mark.parametrize("fn,values,expected,dtype", [
    (lambda c: S.customer_segment(CFG, c), [1000.0, 999.99, 500.0, 499.99, None],
     ["Premium", "Standard", "Standard", "Basic", "Basic"], "double"),
    (lambda c: S.frequency_segment(CFG, c), [10, 9, 5, 4, 2, 1, None],
     ["Frequent", "Regular", "Regular", "Occasional", "Occasional", "One-time", "One-time"], "bigint"),
    (lambda c: S.value_segment(CFG, c), [1000.0, 500.0, 499.0, None],
     ["High Value", "Medium Value", "Low Value", "Low Value"], "double"),
    (lambda c: S.recency_segment(CFG, c), [30, 31, 90, 91, 180, 181, None],
     ["Recent", "Moderately Recent", "Moderately Recent", "At Risk", "At Risk", "Dormant", "Dormant"], "int"),
    (lambda c: S.vintage_segment(c), [90, 91, 365, 366, 730, 731, None],
     ["New", "Growing", "Growing", "Established", "Established", "Veteran", "Veteran"], "int"),
    (lambda c: S.purchase_value_segment(c), [20, 19, 10, 9, 3, 2, None],
     ["high_value", "medium_value", "medium_value", "low_value", "low_value", "minimal_value",
      "minimal_value"], "bigint"),
    (lambda c: S.engagement_level(c), [20.0, 19.9, 10.0, 9.9, 5.0, 4.9, None],
     ["highly_engaged", "moderately_engaged", "moderately_engaged", "lightly_engaged", "lightly_engaged",
      "disengaged", "disengaged"], "double"),
])
def test_case_chains(spark, fn, values, expected, dtype):
    assert evaluate(spark, fn, values, dtype) == expected


def test_churn_risk(spark):
    df = spark.createDataFrame([(31, 9.0), (30, 2.9), (30, 3.0), (15, 9.0), (14, 7.9), (14, 8.0), (None, None)],
                               "d int, a double")
    got = [r.o for r in df.select(S.churn_risk("d", "a").alias("o")).collect()]
    assert got == ["high", "high", "medium", "medium", "medium", "low", "low"]


def test_price_stability(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0), (10.0, 11.0, 10.0), (10.0, 13.0, 10.0), (10.0, 14.0, 10.0)],
                               "lo double, hi double, av double")
    got = [r.o for r in df.select(S.price_stability("lo", "hi", "av").alias("o")).collect()]
    assert got == ["Stable", "Low Variance", "Medium Variance", "High Variance"]


def test_guarded_rate_and_consistency(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 0)], "n bigint, d bigint")
    assert [r.o for r in df.select(S.guarded_rate("n", "d").alias("o")).collect()] == [0.333, 0.0, 0.0]
    dd = spark.sql("SELECT 3L AS a, DATE'2024-01-05' AS l, DATE'2024-01-01' AS f "
                   "UNION ALL SELECT 1L, DATE'2024-01-01', DATE'2024-01-01'")
    assert [r.o for r in dd.select(S.consistency_score("a", "l", "f").alias("o")).collect()] == [75.0, None]


def test_avg_days_between(spark):
    df = spark.createDataFrame([(10, 3), (10, 1)], "t int, n bigint")
    assert [r.o for r in df.select(S.avg_days_between("t", "n").alias("o")).collect()] == [5.0, None]


def test_popularity_and_engagement_score(spark):
    df = spark.createDataFrame([(10, 100, 3, 2, 1)], "u bigint, t bigint, v int, c int, p int")
    r = df.select(S.popularity_score("u", "t").alias("s"), S.engagement_score("v", "c", "p").alias("e")).first()
    assert r.s == 0.64 and r.e == 23


def test_price_tier(spark):
    assert evaluate(spark, lambda c: S.price_tier(CFG, c), [10.0, 10.01, 100.0, 100.01, None]) == \
        ["Low", "Medium", "Medium", "High", "High"]
