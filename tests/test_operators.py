import pytest
from pyspark.sql import functions as F

from strata.config import ENVIRONMENTS, PipelineConfig, get_config, parse_bytes
from strata.operators.dedup import dedup_by_key
from strata.operators.pivot import conditional_counts, pivot_counts
from strata.operators.topk import top_k
from strata.sinks.writers import cluster_columns, measured, records_per_file, write_json, write_table
from strata.sources.schemas import ORDERS_SCHEMA, build_schema


def test_familiar_helper_names():
    cfg = get_config("dev")
    assert cfg.get_table_name("silver", "orders") == cfg.table_name("silver", "orders")
    assert cfg.get_streaming_options() == {"maxFilesPerTrigger": "100"}
    assert cfg.get_gold_table_properties(["a", "b"])["cluster_cols"] == "a,b"
    assert build_schema() == ORDERS_SCHEMA


def test_schema_spec():
    with pytest.raises(ValueError, match="Unsupported column type: DATE"):
        build_schema([("d", "DATE", True)])
    assert [f.dataType.simpleString() for f in ORDERS_SCHEMA.fields][6:8] == ["int", "double"]


def test_config(monkeypatch):
    assert get_config("prod").target_file_size_mb == 256 and get_config("staging").max_files_per_trigger == 500
    monkeypatch.setenv("PIPELINE_ENV", "staging")
    assert get_config().environment == "staging"
    with pytest.raises(ValueError):
        get_config("qa")
    assert ENVIRONMENTS["prod"].orders_source_path.startswith("/data/prod/")
    assert parse_bytes("1gb") == 1 << 30 and parse_bytes("512 MB") == 512 << 20
    assert PipelineConfig().streaming_options() == {"maxFilesPerTrigger": "1000"}
    assert PipelineConfig(rate_limit="bytes").streaming_options() == {"maxBytesPerTrigger": str(1 << 30)}
    assert PipelineConfig(catalog="c", schema="s").table_name("gold", "daily_sales") == "c.s.gold_daily_sales"
    props = get_config("prod").table_properties("gold", ["customer_id"])
    assert props["quality"] == "gold" and props["target_file_size"] == str(256 << 20)
    assert props["log_retention"] == "interval 90 days"


def test_dedup_hot_key_and_nulls(spark):
    rows = [("k", i % 7, f"v{i}") for i in range(5000)] + [(None, 3, "a"), (None, 1, "b"), ("z", None, "c"),
                                                           ("z", 0, "d")]
    df = spark.createDataFrame(rows, "k string, q int, v string").repartition(8)
    out = {r.k: r for r in dedup_by_key(df, ["k"], ["q", "v"]).collect()}
    assert out["k"].q == 0 and out["k"].v == "v0"
    assert out[None].v == "b" and out["z"].v == "c"  # NULL keys are one group; NULL orders first
    plan = dedup_by_key(df, ["k"], ["q"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle


def test_pivot_forms_agree(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None)], "k int, d string")
    a = sorted(pivot_counts(df, "k", "d", ["a", "b"], "_n").collect())
    b = sorted(conditional_counts(df, "k", "d", ["a", "b"], "_n").collect())
    assert a == b and a[0].a_n == 2 and a[2].b_n == 0


def test_top_k(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 37) % 101)
    got = [r.id for r in top_k(df, 3, [F.col("v").desc(), "id"]).collect()]
    expected = sorted(range(1000), key=lambda i: (-(i * 37 % 101), i))[:3]
    assert got == expected


def test_cluster_columns_and_file_budget(spark):
    df = spark.range(10).withColumn("d", F.lit("x"))
    assert cluster_columns(df, ["d", "id"], ["d"]) == ["id"]
    with pytest.raises(ValueError):
        cluster_columns(df, ["customer_segment"])
    assert records_per_file(df, 64 << 20) > 1000


def test_files_sized_from_measured_rows(spark, tmp_path):
    target, path = 1 << 20, str(tmp_path / "t")
    # 64 hexadecimal digits a row: far from the width that the type suggests.
    df = spark.range(60_000).withColumn("s", F.sha2(F.col("id").cast("string"), 256))
    assert measured(spark, path) is None
    write_table(df, path, cluster_cols=["id"], target_file_size_bytes=target)
    row, total = measured(spark, path)
    assert 30 < row < 80 and abs(total / row - 60_000) < 1
    write_table(df, path, cluster_cols=["id"], target_file_size_bytes=target)
    sizes = [f.stat().st_size for f in (tmp_path / "t").glob("*.parquet")]
    assert all(abs(size - target) < 0.25 * target for size in sizes) and len(sizes) == round(total / target)
    assert spark.read.parquet(path).distinct().count() == 60_000
    # Within a partition column's value, files are cut at the measured rows.
    both = df.withColumn("d", F.lit("x"))
    for _ in range(2):
        write_table(both, str(tmp_path / "p"), ["d"], ["id"], target)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "p").glob("d=x/*.parquet"))
    assert all(abs(size - target) < 0.25 * target for size in sizes[1:])
    # An empty table has no width.
    write_table(df.limit(0), str(tmp_path / "e"), target_file_size_bytes=target)
    assert measured(spark, str(tmp_path / "e")) is None


def test_write_table_partitioned_clustered(spark, tmp_path):
    df = spark.range(100).withColumn("d", (F.col("id") % 3).cast("string"))
    p = write_table(df, str(tmp_path / "t"), partition_cols=["d"], cluster_cols=["d", "id"],
                    target_file_size_bytes=1 << 20)
    back = spark.read.parquet(p)
    assert back.count() == 100 and back.filter("d = '1'").count() == 33
    j = write_json(df.withColumn("n", F.lit(None).cast("int")), str(tmp_path / "j"))
    text = "".join(open(f).read() for f in __import__("glob").glob(j + "/*.json"))
    assert '"n"' not in text  # NULL fields are left out


def test_sizing_scales_with_input():
    from strata.session import sizing
    big = sizing(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // 2 // (256 << 20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    small = sizing(20 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20


def test_rebalanced_write_splits_a_hot_partition_value(spark, tmp_path):
    """A partition value with a third of the rows is written by several tasks."""
    import glob
    df = spark.range(300000).withColumn("d", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                         .otherwise((F.col("id") % 50).cast("string")))
    df = df.withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(256 << 10))
    try:
        p = write_table(df, str(tmp_path / "t"), partition_cols=["d"], cluster_cols=["id"])
    finally:
        spark.conf.set(key, old)
    hot_files = glob.glob(f"{p}/d=hot/*.parquet")
    cold_files = glob.glob(f"{p}/d=1/*.parquet")
    assert len(hot_files) > 1 and len(cold_files) >= 1
    assert spark.read.parquet(p).filter("d = 'hot'").count() == 100000


def test_small_helpers(spark, tmp_path):
    from strata.operators.topk import first_rows, sort_by
    from strata.sinks.writers import preview, row_count
    from strata.sources.readers import read_table, read_table_stream
    df = spark.range(50).withColumn("v", (F.col("id") * 7) % 11)
    assert first_rows(df, 5).count() == 5 and preview(df, 3).count() == 3 and row_count(df) == 50
    assert [r.v for r in sort_by(df, [F.col("v").desc(), "id"]).limit(2).collect()] == [10, 10]
    p = str(tmp_path / "t")
    df.write.parquet(p)
    assert read_table(spark, p).count() == 50
    s = read_table_stream(spark, p)
    assert s.isStreaming and s.columns == ["id", "v"]
    with pytest.raises(ValueError):
        parse_bytes("lots")


def test_stream_reader_infers_schema_once(spark, tmp_path):
    from strata.sources.readers import read_json
    d = tmp_path / "j"
    d.mkdir()
    (d / "a.json").write_text('{"order_id": 1, "price": 2.5}\n')
    s = read_json(spark, str(d), None, stream=True)
    assert s.isStreaming and dict(s.dtypes) == {"order_id": "bigint", "price": "double"}


def test_table_comment_and_properties(spark, tmp_path):
    from strata.sinks.writers import table_info
    df = spark.range(10).withColumn("d", (F.col("id") % 2).cast("string"))
    p = write_table(df, str(tmp_path / "t"), ["d"], comment="ten rows", properties={"quality": "gold"})
    assert table_info(spark, p) == {"comment": "ten rows", "properties": {"quality": "gold"}}
    back = spark.read.parquet(p)
    assert back.count() == 10 and sorted(back.columns) == ["d", "id"]  # the sidecar is not part of the table
