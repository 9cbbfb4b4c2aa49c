"""Work per task and per batch that must not grow with the input."""

import glob

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.distinct import agg_with_distinct
from strata.plans import gold_state as GS
from strata.plans import orders as OR
from strata.plans import query_inputs as QI
from strata.plans import registry, scenarios
from strata.sinks import snapshots as S
from strata.sinks import writers
from strata.sources import bindings as B

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows, least, files", [(0, 4, 4), (1_000_000, 4, 4), (1_000_001, 4, 5), (216_000_000, 2, 864)])
def test_json_files_grow_with_the_rows(rows, least, files):
    assert writers.json_files(rows, least) == files


def test_hand_over_is_written_by_more_tasks_as_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(writers, "JSON_ROWS", 500)
    rows = B.row_count(spark, SF, "lineitem")
    out = registry.QUERIES["json_round_trip"](spark, SF)
    assert len(out.inputFiles()) == -(-rows // 500) > 4 and out.count() == rows


def test_evolving_sources_are_written_by_more_tasks_as_rows_grow(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(writers, "JSON_ROWS", 500)
    monkeypatch.setattr(scenarios, "new_work_path", lambda spark, label: str(tmp_path))
    assert scenarios.q_sample_bronze_evolving(spark, SF).count() == B.row_count(spark, SF, "lineitem")
    assert len(glob.glob(f"{tmp_path}/orders_raw/run1/part-*")) > 4


def test_first_and_other_rows_of_a_key(spark, monkeypatch):
    """All rows, once each: the smallest row of a key first, null products and equal rows included."""
    raw = spark.createDataFrame([("1", "c", "2024-01-01", p, "n", "k", q, 1.0, "s") for p, q in
                                 [("1", 1), ("2", 3), ("2", 2), ("2", 2), (None, 5), (None, 4), ("3", 7)]],
                                "order_id string, customer_id string, order_date string, product_id string, product_name string, "
                                "category string, quantity int, price double, status string")
    raw = raw.withColumn("customer_id", F.lit("9"))
    monkeypatch.setattr(B, "raw_orders", lambda spark, sf_dir: raw)
    first, rest = QI.orders_first_and_rest(spark, SF)

    def of(df):
        return sorted((r["product_id"] or 0, r["quantity"]) for r in df.collect())
    assert of(first) == [(0, 4), (1, 1), (2, 2), (3, 7)] and of(rest) == [(0, 5), (2, 2), (2, 3)]
    ranked = QI.json_orders(raw).withColumn("r", F.row_number().over(Window.partitionBy(*OR.ORDER_KEYS).orderBy("quantity")))
    assert of(first) == of(ranked.filter("r = 1")) and of(rest) == of(ranked.filter("r > 1"))


def test_a_written_batch_is_not_read_again(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "_contents", lambda *a: pytest.fail("the written folder was read"))
    rows = spark.range(50).select("id", F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("d"))
    S.append_batch(rows, str(tmp_path), 0, partition_cols=["d"], date_col="d")
    assert [(p.rows, p.months) for p in S.added_since(spark, str(tmp_path), 0)] == [(50, ("2024-01", "2024-02"))]


def test_seen_values_take_few_files(spark, tmp_path):
    """An update's values: a file or two a bucket, whatever the number of tasks."""
    silver = registry._silver_orders(spark, SF)
    path, root = str(tmp_path / "silver"), str(tmp_path)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many tasks as on a large table
    try:
        for i in range(2):
            S.append_batch(silver.filter(F.pmod(F.xxhash64("order_id"), F.lit(2)) == i), path, i, date_col="order_date")
            GS.update_state(spark, path, root, GS.CUSTOMER)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = glob.glob(f"{root}/_state_customer_values/batch=*/bucket=*/*.parquet")
    assert len(files) <= 2 * 2 * GS.BUCKETS
    got = GS.merged(spark, root, GS.CUSTOMER).agg(F.sum("total_orders"), F.sum("lines")).first()
    want = OR.gold_customer_insights(silver, QI.QUERY_CFG, "2024-06-01").agg(F.sum("total_orders"), F.sum("total_line_items")).first()
    assert tuple(got) == tuple(want)


def test_distinct_counts_without_widened_rows(spark):
    """No Expand, which repeated each row with the buffers of all aggregates; same figures, NULLs included."""
    rows = spark.range(300).selectExpr("IF(id % 7 = 0, NULL, id % 5) AS g", "id % 11 AS a", "IF(id % 3 = 0, NULL, CAST(id % 4 AS STRING)) AS b", "id AS x")
    got = agg_with_distinct(rows, ["g"], [F.sum("x").alias("s"), F.max("a").alias("m")], {"da": "a", "db": "b"})
    want = rows.groupBy("g").agg(F.sum("x").alias("s"), F.max("a").alias("m"), F.count_distinct("a").alias("da"), F.count_distinct("b").alias("db"))
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = registry.QUERIES["ml_feature_table"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_product_figures_without_widened_rows(spark):
    plan = registry.QUERIES["gold_product_performance"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_state_is_updated_in_passes(spark, tmp_path, monkeypatch):
    """However many values are known, a pass meets about PASS_ROWS of them; same figures, also of an update that is repeated."""
    monkeypatch.setattr(GS, "PASS_ROWS", 4000)
    silver = registry._silver_orders(spark, SF)
    path, root, sizes = str(tmp_path / "silver"), str(tmp_path), []
    unseen = GS._unseen

    def counted(met, seen):
        sizes.append(met.count() + (seen.count() if seen is not None else 0))
        return unseen(met, seen)
    monkeypatch.setattr(GS, "_unseen", counted)
    for i in range(3):
        S.append_batch(silver.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == i), path, i, date_col="order_date")
        if i == 2:
            append = S.append_batch
            monkeypatch.setattr(S, "append_batch", lambda df, to, *a, **kw: 1 / 0 if to.endswith("_values") else append(df, to, *a, **kw))
            with pytest.raises(ZeroDivisionError):
                GS.update_state(spark, path, root, GS.PRODUCT)
            monkeypatch.setattr(S, "append_batch", append)
        GS.update_state(spark, path, root, GS.PRODUCT)
        if i == 1:
            GS.compact_state(spark, root, GS.PRODUCT)
    assert len(sizes) > 6 and max(sizes) < 6000 < sum(sizes)
    got = GS.merged(spark, root, GS.PRODUCT).select("product_id", "unique_customers", "unique_orders", "lines")
    want = silver.groupBy("product_id").agg(F.count_distinct("customer_id"), F.count_distinct("order_id"), F.count(F.lit(1)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_silver_of_the_updates_is_written_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scenarios, "new_work_path", lambda spark, label: str(tmp_path))
    scenarios._three_updates(spark, SF, GS.PRODUCT)
    assert not glob.glob(f"{tmp_path}/silver/*") and len(glob.glob(f"{tmp_path}/silver_orders/batch=0-*")) == 3
    silver, want = S.read(spark, f"{tmp_path}/silver_orders"), registry._silver_orders(spark, SF)
    assert sorted(map(str, silver.collect())) == sorted(map(str, QI.public(want).collect()))


def test_hand_overs_of_streams_are_compressed_and_not_dealt_anew(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(writers, "JSON_ROWS", 500)
    rows = spark.range(0, 3000, 1, 3)
    assert writers.write_hand_over(rows, str(tmp_path / "few"), 900, 2) == 2
    assert writers.write_hand_over(rows, str(tmp_path / "many"), 3000, 2) == 6  # two of each task
    many = spark.read.json(str(tmp_path / "many")).groupBy(F.input_file_name().alias("f")).agg(F.min("id").alias("a"), F.max("id").alias("b"))
    assert all(r["b"] - r["a"] == 499 and r["f"].endswith(".gz") for r in many.collect())


def test_lines_of_an_evolving_source_are_compressed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scenarios, "new_work_path", lambda spark, label: str(tmp_path))
    assert scenarios.q_sample_bronze_evolving(spark, SF).count() == B.row_count(spark, SF, "lineitem")
    written = glob.glob(f"{tmp_path}/orders_raw/run*/part-*") + glob.glob(f"{tmp_path}/checkpoint.grown/*/part-*")
    assert len(written) >= 6 and all(f.endswith(".gz") for f in written)


@pytest.mark.parametrize("collide", [False, True])
def test_other_rows_than_repeated_ones_are_not_dealt(spark, monkeypatch, collide):
    """Not sorted and merged whatever Spark's own limit says; keys that share a hash stay apart."""
    raw = B.raw_orders(spark, SF).cache()
    monkeypatch.setattr(B, "raw_orders", lambda spark, sf_dir: raw)
    if collide:
        hashed = F.xxhash64
        monkeypatch.setattr(QI.F, "xxhash64", lambda *c: hashed(*c) % 50)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first, rest = QI.orders_first_and_rest(spark, SF)
        plan = first._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert first.count() == raw.select(*OR.ORDER_KEYS).distinct().count() and first.count() + rest.count() == raw.count()
    raw.unpersist()


def test_dedup_state_is_on_disk_in_any_session(spark, json_dir, tmp_path):
    """A session with Spark's own default kept it in the executors' heaps."""
    import json

    from strata.config import PipelineConfig
    from strata.session import session_conf
    from strata.streaming import runner as R
    lay, name = R.StreamLayout(str(tmp_path / "p")), "spark.sql.streaming.stateStore.providerClass"
    json_dir([json.dumps({"order_id": f"o{i % 20}", "customer_id": "c", "order_date": "2024-01-05", "product_id": "p", "product_name": "n",
                          "category": "k", "quantity": 1, "price": 5.0, "status": "s"}) for i in range(30)], name="raw/1")
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with session_conf(spark, {name: default}):
        R.run_orders_increment(spark, PipelineConfig(), str(tmp_path / "raw/*"), lay)
        assert spark.conf.get(name) == default and spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", None) is None
    assert glob.glob(f"{lay.checkpoint('silver_orders')}/state/0/*/*.zip")  # snapshots of stores on disk
    assert S.read(spark, lay.table("silver_orders")).count() == 20
