"""Streaming specifics: bounded dedup mode, incremental runs, observed metrics, SQL over tables."""

import json

import pytest

from strata.config import PipelineConfig
from strata.operators.dedup import FIRST_ARRIVAL, WITHIN_WATERMARK
from strata.operators.setops import distinct_values, union_by_name
from strata.plans.adhoc import register_paths, run_sql
from strata.sinks.writers import write_table
from strata.streaming.runner import StreamLayout, run_activity_increment, run_orders_increment

CFG = PipelineConfig(max_files_per_trigger=1)


def order(oid, q=1, pid="p1"):
    return json.dumps({"order_id": oid, "customer_id": "c", "order_date": "2024-01-05", "product_id": pid,
                       "product_name": "n", "category": "k", "quantity": q, "price": 5.0, "status": "s"})


def test_within_watermark_mode_dedups_inside_a_run(spark, json_dir, tmp_path):
    json_dir([order("a"), order("a", 2), order("b")], name="raw/1")
    lay = StreamLayout(str(tmp_path / "p"))
    rep = run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, WITHIN_WATERMARK)
    rows = spark.read.parquet(lay.table("silver_orders")).collect()
    assert sorted(r.order_id for r in rows) == ["a", "b"]
    assert rep["expectations"]["total_records"] == 2


def test_incremental_runs_process_only_new_files(spark, json_dir, tmp_path):
    lay = StreamLayout(str(tmp_path / "p"))
    json_dir([order("a")], name="raw/1")
    r1 = run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, FIRST_ARRIVAL)
    r0 = run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, FIRST_ARRIVAL)
    json_dir([order("b"), order("a", 3)], name="raw/2")
    r2 = run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, FIRST_ARRIVAL)
    assert (r1["bronze_rows"], r0["bronze_rows"], r2["bronze_rows"]) == (1, 0, 2)
    out = {r.order_id: r.quantity for r in spark.read.parquet(lay.table("silver_orders")).collect()}
    assert out == {"a": 1, "b": 1}  # the late copy of "a" is rejected by the dedup state


def test_batch_write_leaves_stream_tables_alone(spark, json_dir, tmp_path):
    lay = StreamLayout(str(tmp_path / "p"))
    json_dir([order("a")], name="raw/1")
    run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, FIRST_ARRIVAL)
    with pytest.raises(ValueError, match="written by a stream"):
        write_table(spark.range(1), lay.table("silver_orders"))
    json_dir([order("b")], name="raw/2")
    run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), lay, FIRST_ARRIVAL)
    assert spark.read.parquet(lay.table("silver_orders")).count() == 2
    other = str(tmp_path / "batch")
    for n in (1, 3):
        write_table(spark.range(n), other)
    assert spark.read.parquet(other).count() == 3


def test_activity_stream(spark, json_dir, tmp_path):
    rows = [json.dumps({"customer_id": 1, "timestamp": "2024-01-06T10:00:00", "page_views": 1, "cart_adds": 0,
                        "purchases": 0, "device": "tablet", "location": "x", "session_id": s}) for s in "abc"]
    json_dir(rows + rows[:1], name="raw/1")
    lay = StreamLayout(str(tmp_path / "p"))
    rep = run_activity_increment(spark, CFG, str(tmp_path / "raw/*"), lay)
    out = spark.read.parquet(lay.table("silver_customer_activity"))
    assert out.count() == 3 and rep["batches"] >= 1
    assert str(out.first().activity_date) == "2024-01-06"  # partition column read back as a date


def test_union_by_name_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    u = union_by_name([a, b]).collect()
    assert [(r.k, r.a, r.b) for r in u] == [(1, "x", None), (2, None, 3.0)]
    assert distinct_values(spark.createDataFrame([(1,), (1,), (2,)], "k int"), "k").count() == 2


def test_sql_over_written_tables(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(20).selectExpr("id", "id % 3 AS g").write.parquet(p)
    register_paths(spark, {"t": p})
    got = run_sql(spark, "SELECT g, count(*) AS n FROM t GROUP BY g ORDER BY n DESC, g LIMIT 1").collect()
    assert (got[0].g, got[0].n) == (0, 7)


def test_fail_mode_stops_a_stream(spark, json_dir, tmp_path):
    import pytest
    from strata.operators.expectations import apply_expectations, expect_or_fail
    from strata.sinks.writers import write_stream
    from strata.sources.readers import bronze_orders
    from strata.streaming.runner import run_to_completion
    json_dir([order("a"), order("b", q=0)], name="raw/1")
    src = bronze_orders(spark, CFG, str(tmp_path / "raw/*"), stream=True)
    checked, _ = apply_expectations(src, [expect_or_fail("valid_quantity", "quantity > 0")], "orders")
    q = write_stream(checked, str(tmp_path / "out"), str(tmp_path / "chk"))
    with pytest.raises(RuntimeError, match="valid_quantity"):
        run_to_completion(q)


def test_bytes_rate_limit(spark, json_dir, tmp_path):
    cfg = PipelineConfig(rate_limit="bytes", max_bytes_per_trigger="1kb")
    for i in range(3):
        json_dir([order(f"o{i}{j}") for j in range(5)], name=f"raw/{i}")
    lay = StreamLayout(str(tmp_path / "p"))
    rep = run_orders_increment(spark, cfg, str(tmp_path / "raw/*"), lay)
    assert rep["bronze_rows"] == 15
    assert spark.read.parquet(lay.table("silver_orders")).count() == 15


def test_stream_write_splits_a_hot_date_and_counts_once(spark, json_dir, tmp_path):
    import glob
    rows = [order(f"h{i}") for i in range(60)] + [
        order(f"c{i}").replace("2024-01-05", f"2024-01-{10 + i % 5:02d}") for i in range(30)]
    json_dir(rows, name="raw/1")
    lay = StreamLayout(str(tmp_path / "p"))
    rep = run_orders_increment(spark, PipelineConfig(), str(tmp_path / "raw/*"), lay)
    assert rep["expectations"]["total_records"] == 90  # observed once per micro-batch
    hot = glob.glob(lay.table("silver_orders") + "/batch=*/order_date=2024-01-05/*.parquet")
    assert 1 < len(hot) <= 4


def test_run_to_completion_timeout(spark, tmp_path):
    import pytest
    from strata.streaming.runner import run_to_completion
    q = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
         .writeStream.format("noop").option("checkpointLocation", str(tmp_path / "chk")).start())
    with pytest.raises(TimeoutError):
        run_to_completion(q, timeout_s=2)
    assert not q.isActive


def test_progress_is_whole_over_more_than_100_batches(spark, tmp_path):
    from strata.streaming.runner import run_to_completion
    spark.range(104).repartition(104).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    assert sum(p["numInputRows"] for p in run_to_completion(q)) == 104
