"""Physical-plan properties the scale design relies on (guards against regressions)."""

import re

import pytest

from strata.plans import orders as OR
from strata.plans.registry import ORDERS_AS_OF, QUERIES, QUERY_CFG
from strata.sinks.writers import write_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["gold_daily_sales"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert set(c.split(":")[0] for c in lineitem.split(",")) == {"l_orderkey", "l_partkey", "l_linenumber",
                                                                 "l_quantity"}


def test_real_time_metrics_single_lineage(spark):
    p = plan(QUERIES["gold_real_time_metrics"](spark, SF))
    assert p.count("FileScan parquet") == 3  # lineitem, orders, part once each


def test_dedup_combines_map_side(spark):
    p = plan(QUERIES["silver_orders"](spark, SF))
    assert "partial_min(struct(" in p
    exch = p.index("Exchange hashpartitioning(order_id")
    assert p.index("partial_min(struct(") > exch  # printed below the exchange = runs before it


def test_partition_pruning_on_written_silver(spark, tmp_path):
    from strata.sources import bindings as B
    silver = OR.silver_orders(B.as_bronze(B.raw_orders(spark, SF)), QUERY_CFG, observe=False)[0]
    path = write_table(silver, str(tmp_path / "silver"), ["order_date"], ["order_date", "order_id"])
    s = spark.read.parquet(path)
    p = plan(OR.gold_real_time_metrics(s, QUERY_CFG, ORDERS_AS_OF))
    assert "PartitionFilters: [isnotnull(order_date" in p and "2001-07-25" in p


@pytest.mark.parametrize("name", ["ml_feature_table"])
def test_ml_join_reuses_aggregate_partitioning(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p
    # dedup, distinct-count level, final aggregate, profile side: the aggregate side is not re-shuffled
    assert p.count("Exchange hashpartitioning") == 4


def test_no_python_udfs_in_plans(spark):
    for name in ["silver_orders", "ml_feature_table", "gen_activity", "gold_customer_insights"]:
        p = plan(QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
