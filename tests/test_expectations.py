import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from strata.config import PipelineConfig
from strata.operators.expectations import (apply_expectations, catalogue_expectations, check_dataset,
                                           expect, expect_or_drop, expect_or_fail, expectation_metrics)


def frame(spark):
    return spark.createDataFrame([(1,), (5,), (None,), (-2,)], "x int")


def test_warn_keeps_rows_and_counts(spark):
    df, obs = apply_expectations(frame(spark), [expect("pos", "x > 0")], "t")
    assert df.count() == 4
    assert obs.get == {"total_records": 4, "failed_pos": 2}  # NULL counts as failed


def test_drop_filters_and_ands(spark):
    df, obs = apply_expectations(frame(spark), [expect_or_drop("pos", "x > 0"),
                                                expect_or_drop("small", "x < 3")], "t")
    assert [r.x for r in df.collect()] == [1]
    assert obs.get["failed_small"] == 2


def test_fail_raises_even_under_count(spark):
    df, _ = apply_expectations(frame(spark), [expect_or_fail("pos", "x > 0")], "t", observe=False)
    with pytest.raises((Py4JJavaError, PySparkException)):
        df.count()


def test_fail_passes_clean_rows(spark):
    df, _ = apply_expectations(frame(spark).filter("x > 0"), [expect_or_fail("pos", "x > 0")], "t")
    assert sorted(r.x for r in df.collect()) == [1, 5]


def test_unknown_mode_rejected(spark):
    from strata.operators.expectations import Expectation
    with pytest.raises(ValueError):
        apply_expectations(frame(spark), [Expectation("a", "x > 0", "maybe")])


def test_metrics_table_sums(spark):
    m = expectation_metrics(frame(spark), [expect_or_drop("pos", "x > 0"), expect("nn", "x IS NOT NULL")], "t")
    rows = {r.expectation: r for r in m.collect()}
    assert rows["pos"].passed_records == 2 and rows["pos"].failed_records == 2
    assert rows["nn"].passed_records + rows["nn"].failed_records == rows["nn"].total_records == 4


def test_dataset_level_check(spark):
    assert check_dataset(frame(spark), "critical_data_quality", "count(*) > 0")
    with pytest.raises(ValueError):
        check_dataset(frame(spark).filter("x > 100"), "critical_data_quality", "count(*) > 0")
    assert not check_dataset(frame(spark).filter("x > 100"), "c", "count(*) > 0", mode="warn")


def test_catalogue_business_rules_use_config():
    exps = catalogue_expectations(PipelineConfig(max_quantity=7), "silver", "business_rules")
    assert exps[0].predicate == "quantity > 0 AND quantity <= 7"
    assert [e.name for e in catalogue_expectations(PipelineConfig(), "bronze", "format_checks")] == \
        ["valid_order_date", "valid_order_date_format"]


def test_materialized_fail_check_runs_eagerly(spark):
    with pytest.raises((Py4JJavaError, PySparkException)):
        apply_expectations(frame(spark), [expect_or_fail("pos", "x > 0")], "t", observe=False, materialize=True)
    ok, _ = apply_expectations(frame(spark).filter("x > 0"), [expect_or_fail("pos", "x > 0")], "t",
                               observe=False, materialize=True)
    assert sorted(r.x for r in ok.collect()) == [1, 5]


@pytest.mark.parametrize("flip", [False, True])
def test_fail_holds_for_rows_that_a_drop_removes(spark, flip):
    df = spark.createDataFrame([(0, -1)], "a int, b int")
    both = [expect_or_drop("drop_a", "a > 0"), expect_or_fail("fail_b", "b > 0")]
    kept, _ = apply_expectations(df, both[::-1] if flip else both, "d", observe=False)
    with pytest.raises(Exception, match="fail_b"):
        kept.collect()
