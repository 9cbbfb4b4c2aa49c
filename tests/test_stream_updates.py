"""Updates over time: batch log, merged gold state, regrown stream state, schema log, batch metrics, late rows."""

import json

import pytest
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.operators.dedup import VALID_FIRST, dedup
from strata.plans import gold_state as GS
from strata.plans import orders as OR
from strata.plans import sketches as SK
from strata.plans.run import refresh_daily_sales, update_orders
from strata.sinks import snapshots as S
from strata.sources.evolving import RESCUED, SchemaLog, read_evolving, run_evolving
from strata.streaming import metrics as M
from strata.streaming import runner as R
from strata.streaming.late import run_with_late_rows

CFG = PipelineConfig(max_files_per_trigger=1)


def order(oid, day="2024-01-05", pid="p1", cid="c", q=1, price=5.0, **more):
    return json.dumps({"order_id": oid, "customer_id": cid, "order_date": day, "product_id": pid, "product_name": "n",
                       "category": "k", "quantity": q, "price": price, "status": "s", **more})


def run(spark, tmp_path, layout):
    return R.run_orders_increment(spark, CFG, str(tmp_path / "raw/*"), layout)


def test_second_refresh_reads_new_months_only(spark, json_dir, tmp_path):
    lay = R.StreamLayout(str(tmp_path / "p"))
    json_dir([order("a"), order("b", "2024-03-01")], name="raw/1")
    run(spark, tmp_path, lay)
    assert refresh_daily_sales(spark, CFG, lay)["full"]
    mark = S.latest_version(spark, lay.table("silver_orders"))
    json_dir([order("c", "2024-03-02"), order("a", q=9)], name="raw/2")
    run(spark, tmp_path, lay)
    new = S.added_since(spark, lay.table("silver_orders"), mark)
    files = S.read_pieces(spark, lay.table("silver_orders"), new).inputFiles()
    assert files and not any("batch=0-00000000" in f for f in files)
    assert refresh_daily_sales(spark, CFG, lay) == {"months": [(2024, 3)], "full": False}
    assert refresh_daily_sales(spark, CFG, lay) == {"months": [], "full": False}


def silver_batches(spark, seed, n=400):
    """Silver rows with repeated customers, products and orders over three batches."""
    return spark.range(n).select(
        F.concat(F.lit("o"), (F.xxhash64("id", F.lit(seed)) % 90).cast("string")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 17).cast("string"))).alias("customer_id"),
        F.concat(F.lit("p"), (F.col("id") % 23).cast("string")).alias("product_id"), F.lit("name").alias("product_name"),
        F.concat(F.lit("k"), (F.col("id") % 5).cast("string")).alias("category"), (F.col("id") % 9 + 1).cast("int").alias("quantity"),
        (F.col("id") % 7 + 0.5).cast("double").alias("price"), ((F.col("id") % 9 + 1) * (F.col("id") % 7 + 0.5)).cast("double").alias("total_item_price"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 50 AS INT))").alias("order_date"))


def rounded(df):
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes if c != "calculated_timestamp"]
    return sorted(map(str, df.select(*cols).collect()))


@pytest.mark.parametrize("compact", [False, True])
def test_merged_state_equals_full_tables(spark, tmp_path, compact):
    path, root, everything = str(tmp_path / "silver"), str(tmp_path), None
    for i in range(3):
        batch = silver_batches(spark, i)
        everything = batch if everything is None else everything.unionByName(batch)
        S.append_batch(batch, path, i, date_col="order_date")
        if i != 1:  # an update may meet several batches
            for state in GS.STATES:
                assert GS.update_state(spark, path, root, state) == (1 if i == 0 else 2)
                assert GS.update_state(spark, path, root, state) == 0
                if compact:
                    GS.compact_state(spark, root, state)
    assert rounded(GS.customer_insights(spark, root, CFG, "2024-06-01")) == rounded(OR.gold_customer_insights(everything, CFG, "2024-06-01"))
    assert rounded(GS.product_performance(spark, root, CFG)) == rounded(OR.gold_product_performance(everything, CFG, ordered=False))


def test_update_that_failed_between_its_tables_is_repeated(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "silver"), str(tmp_path)
    S.append_batch(silver_batches(spark, 0), path, 0, date_col="order_date")
    append = S.append_batch

    def fails(df, to, *a, **kw):
        if to.endswith("_values"):
            raise OSError("lost")
        return append(df, to, *a, **kw)
    monkeypatch.setattr(GS.snapshots, "append_batch", fails)
    with pytest.raises(OSError):
        GS.update_state(spark, path, root, GS.CUSTOMER)
    monkeypatch.setattr(GS.snapshots, "append_batch", append)
    GS.update_state(spark, path, root, GS.CUSTOMER)
    want = OR.gold_customer_insights(silver_batches(spark, 0), CFG, "2024-06-01")
    assert rounded(GS.customer_insights(spark, root, CFG, "2024-06-01")) == rounded(want)


def test_update_orders_keeps_all_gold_tables(spark, json_dir, tmp_path):
    lay = R.StreamLayout(str(tmp_path / "p"))
    for i, lines in enumerate(([order("a"), order("a", pid="p2", q=3)], [order("b", "2024-02-05", cid="d"), order("c", pid="p2")]), 1):
        json_dir(lines, name=f"raw/{i}")
        rep = update_orders(spark, CFG, str(tmp_path / "raw/*"), lay, "2024-03-01")
    silver = S.read(spark, lay.table("silver_orders"))
    got = spark.read.parquet(rep.tables["gold_customer_insights"])
    assert rounded(got) == rounded(OR.gold_customer_insights(silver, CFG, "2024-03-01"))
    assert rounded(spark.read.parquet(rep.tables["gold_product_performance"])) == rounded(OR.gold_product_performance(silver, CFG, ordered=False))
    assert spark.read.parquet(rep.tables["silver_customers"]).count() == 2


@pytest.mark.parametrize("stream", [R.ORDERS, R.ACTIVITY], ids=["orders", "activity"])
def test_state_grows_and_rejects_what_it_knew(spark, json_dir, tmp_path, stream):
    lay = R.StreamLayout(str(tmp_path / "p"))

    def session(s):
        return json.dumps({"customer_id": 1, "timestamp": "2024-01-06T10:00:00", "page_views": 1, "cart_adds": 0, "purchases": 0,
                           "device": "tablet", "location": "x", "session_id": s})
    line, go = (order, R.run_orders_increment) if stream is R.ORDERS else (session, R.run_activity_increment)
    json_dir([line(f"o{i}") for i in range(30)], name="raw/1")
    go(spark, CFG, str(tmp_path / "raw/*"), lay)
    before = R.state_partitions(spark, lay, stream)
    assert R.regrow_state(spark, CFG, lay, stream, 3 * before) == 1
    assert R.state_partitions(spark, lay, stream) == 3 * before
    table = lay.table(f"silver_{stream.entity}")
    assert S.read(spark, table).count() == 30
    json_dir([line(f"o{i}") for i in range(20, 45)], name="raw/2")
    rep = go(spark, CFG, str(tmp_path / "raw/*"), lay)
    assert S.read(spark, table).count() == 45 and rep["expectations"]["total_records"] == 15
    R.regrow_state(spark, CFG, lay, stream, 2)
    json_dir([line(f"o{i}") for i in range(40, 50)], name="raw/3")
    go(spark, CFG, str(tmp_path / "raw/*"), lay)
    assert S.read(spark, table).count() == 50 and R.state_partitions(spark, lay, stream) == 2
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 8


def test_batch_metrics_have_a_row_for_each_batch(spark, json_dir, tmp_path):
    lay = R.StreamLayout(str(tmp_path / "p"))
    for i in range(3):
        json_dir([order(f"a{i}"), order(f"b{i}", q=0)], name=f"raw/{i}")
    run(spark, tmp_path, lay)
    json_dir([order("z", price=-1.0)], name="raw/9")
    run(spark, tmp_path, lay)
    path = lay.table("_dq_batches")
    rows = M.batch_metrics(spark, path).filter("expectation IN ('valid_quantity', 'valid_price')").orderBy("batch_id", "expectation").collect()
    ids = sorted({r["batch_id"] for r in rows})
    assert ids == list(range(len(ids))) and len(rows) == 2 * len(ids)
    assert sum(r["failed_records"] for r in rows if r["expectation"] == "valid_quantity") == 3
    assert sum(r["failed_records"] for r in rows if r["expectation"] == "valid_price") == 1
    assert M.missing_batches(spark, path).count() == 0
    progress = [{"batchId": 7, "observedMetrics": {"dq_silver_orders": {"total_records": 5, "failed_x": 2}}}]
    M.record_batches(spark, path, progress, "silver_orders")
    M.record_batches(spark, path, progress, "silver_orders")  # again: replaced, not added
    assert M.batch_metrics(spark, path).filter("batch_id = 7").count() == 1
    gap = M.missing_batches(spark, path).collect()
    assert [(r["after_batch"], r["missing"]) for r in gap] == [(ids[-1], 7 - ids[-1] - 1)]


def test_gaps_in_batch_ids_are_an_error():
    assert M.without_gaps([{"batchId": 4}, {"batchId": 5}])
    with pytest.raises(RuntimeError, match=r"\[5\]"):
        M.without_gaps([{"batchId": 4}, {"batchId": 6}])


def test_new_fields_become_columns(spark, json_dir, tmp_path):
    where = (str(tmp_path / "raw/*"), str(tmp_path / "t"), str(tmp_path / "cp"))
    json_dir(['{"a": 1, "b": "x"}', '{"a": 2}', "not json", ""], name="raw/1")
    assert run_evolving(spark, *where) == {"rows": 4, "changes": 1}
    assert run_evolving(spark, *where)["changes"] == 0
    json_dir(['{"a": 3, "c": {"d": 1.5}}', '{"a": "text now", "b": "y"}'], name="raw/2")
    assert run_evolving(spark, *where)["changes"] == 1
    got = read_evolving(spark, *where[1:])
    assert dict(got.dtypes) == {"a": "bigint", "b": "string", "c": "struct<d:double>", RESCUED: "string"}
    rows = sorted((r["a"], r["b"], r["c"] and r["c"]["d"], r[RESCUED]) for r in got.filter("a IS NOT NULL").collect())
    assert rows == [(1, "x", None, None), (2, None, None, None), (3, None, 1.5, None)]
    assert {r[RESCUED] for r in got.filter(f"{RESCUED} IS NOT NULL").collect()} == {"not json", '{"a": "text now", "b": "y"}'}
    assert SchemaLog(spark, where[2] + ".schema").last()[0] == 2


def test_rows_behind_the_watermark_are_kept(spark, json_dir, tmp_path):
    where = [str(tmp_path / x) for x in ("on_time", "late", "cp")]

    def go():
        stream = spark.readStream.schema("k int, t timestamp").option("maxFilesPerTrigger", 100).json(str(tmp_path / "raw/*"))
        return run_with_late_rows(spark, stream, "t", "2 days", *where)
    json_dir(['{"k": 1, "t": "2024-01-10T00:00:00"}', '{"k": 2, "t": "2024-01-01T00:00:00"}', '{"k": 3}'], name="raw/1")
    assert go() == {"on_time": 3, "late": 0}  # a batch's own rows don't make each other late
    json_dir(['{"k": 4, "t": "2024-01-08T00:00:00"}', '{"k": 5, "t": "2024-01-07T23:59:59"}', '{"k": 6, "t": "2024-02-01T00:00:00"}'], name="raw/2")
    assert go() == {"on_time": 2, "late": 1}
    json_dir(['{"k": 7, "t": "2024-01-29T00:00:00"}', '{"k": 8}'], name="raw/3")
    assert go() == {"on_time": 1, "late": 1}
    assert sorted(r["k"] for r in S.read(spark, where[1]).collect()) == [5, 7]


def test_first_valid_row_stays(spark):
    df = spark.createDataFrame([("a", 0), ("a", 3), ("a", 5), ("b", 0), ("c", None), ("c", 2)], "k string, q int")
    got = {r["k"]: r["q"] for r in dedup(df, ["k"], VALID_FIRST, ["q"], F.col("q") > 0).collect()}
    assert got == {"a": 3, "b": 0, "c": 2}
    with pytest.raises(ValueError, match="valid"):
        dedup(df, ["k"], VALID_FIRST)


def test_sketches_merge_within_five_percent(spark):
    silver = spark.range(60_000).select(
        F.expr("date_add(DATE'2024-01-01', CAST(id % 90 AS INT))").alias("order_date"), (F.col("id") % 7000).cast("string").alias("customer_id"),
        (F.col("id") / 2).cast("long").cast("string").alias("order_id")).withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    daily = SK.daily_customer_sketches(silver)
    for keys in (["order_year"], ["order_year", "order_month"]):
        exact = {tuple(r[:-2]): r[-2:] for r in silver.groupBy(*keys).agg(F.count_distinct("customer_id"), F.count_distinct("order_id")).collect()}
        for r in SK.roll_up(daily, *keys).collect():
            customers, orders = exact[tuple(r[k] for k in keys)]
            assert customers > 1000 and abs(r["approx_customers"] - customers) <= 0.05 * customers
            assert abs(r["approx_orders"] - orders) <= 0.05 * orders


def test_sample_edition_runs_over_updates(spark, json_dir, tmp_path):
    from strata.plans.run import update_sample
    lay = R.StreamLayout(str(tmp_path / "p"))

    def line(k, day, q=2, **more):
        return json.dumps({"order_id": k, "customer_id": k % 3, "order_date": day, "product_id": 7, "product_name": "n", "category": "k",
                           "quantity": q, "price": 5.0, **more})
    json_dir([line(1, "2024-01-05", status="s"), line(2, "2024-01-05", q=0, status="s")], name="raw/1")
    rep = update_sample(spark, CFG, str(tmp_path / "raw/*"), lay, "2024-02-01")
    assert rep.expectations["sample_silver_orders"]["failed_valid_quantity"] == 1
    json_dir([line(4, "2024-01-06", status="t", channel="web")], name="raw/2")
    rep = update_sample(spark, CFG, str(tmp_path / "raw/*"), lay, "2024-02-01")
    daily = {str(r["order_date"]): r["total_items_sold"] for r in spark.read.parquet(rep.tables["sample_daily_sales"]).collect()}
    assert daily == {"2024-01-05": 2, "2024-01-06": 2}
    assert spark.read.parquet(rep.tables["sample_customer_insights"]).count() == 1
    assert {t for t in rep.tables} >= {"sample_silver_customers", "sample_product_performance", "sample_bronze_orders"}
