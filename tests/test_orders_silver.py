"""Silver orders on hand-made rows (one case per planted defect and bound)."""

import json

import pytest
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.operators.dedup import FIRST_ARRIVAL
from strata.plans.orders import silver_orders
from strata.sources.readers import bronze_orders

CFG = PipelineConfig()
GOOD = {"order_id": "o1", "customer_id": "c1", "order_date": "2024-01-05", "product_id": "p1",
        "product_name": "Laptop", "category": "Electronics", "quantity": 2, "price": 50.0,
        "status": "completed"}


def row(**kw):
    r = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            r.pop(k)
        else:
            r[k] = v
    return json.dumps(r)


def silver(spark, path):
    df, metrics = silver_orders(bronze_orders(spark, CFG, path, stream=False), CFG)
    rows = df.collect()
    return rows, metrics


def kept(spark, json_dir, **kw):
    rows, _ = silver(spark, json_dir([row(**kw)]))
    return rows


def test_good_row_kept_with_derived_columns(spark, json_dir):
    (r,) = kept(spark, json_dir)
    assert r.total_item_price == 100.0
    assert str(r.order_date) == "2024-01-05"
    assert (r.order_year, r.order_month, r.order_quarter) == (2024, 1, 1)
    assert r.order_day_of_week == 6  # Friday; Sunday = 1
    assert r.price_tier == "Medium"
    assert r.source_file.endswith(".json")


def test_numeric_id_read_as_string(spark, json_dir):
    (r,) = kept(spark, json_dir, order_id=1)
    assert r.order_id == "1"


@pytest.mark.parametrize("date", ["invalid-date", "2024-02-30", None])
def test_bad_dates_dropped(spark, json_dir, date):
    assert kept(spark, json_dir, order_date=date) == []


def test_blank_id_and_missing_product_dropped(spark, json_dir):
    assert kept(spark, json_dir, order_id="  ") == []
    assert kept(spark, json_dir, product_id=...) == []


@pytest.mark.parametrize("q,n", [(0, 0), (-1, 0), (10000, 1), (10001, 0), (1.5, 0)])
def test_quantity_bounds(spark, json_dir, q, n):
    assert len(kept(spark, json_dir, quantity=q)) == n


@pytest.mark.parametrize("p,n", [(0, 0), (100000, 1), (100000.01, 0), ("oops", 0)])
def test_price_bounds(spark, json_dir, p, n):
    assert len(kept(spark, json_dir, price=p)) == n


def test_null_text_defaults(spark, json_dir):
    (r,) = kept(spark, json_dir, status=..., category=..., product_name=...)
    assert (r.status, r.category, r.product_name) == ("unknown", "uncategorized", "unknown")


@pytest.mark.parametrize("price,tier", [(10.0, "Low"), (10.01, "Medium"), (100.0, "Medium"), (100.01, "High")])
def test_price_tier_bounds(spark, json_dir, price, tier):
    (r,) = kept(spark, json_dir, price=price)
    assert r.price_tier == tier


def test_duplicate_key_keeps_one_repeatably(spark, json_dir):
    path = json_dir([row(quantity=3), row(quantity=2), row(quantity=5)])
    rows, _ = silver(spark, path)
    assert len(rows) == 1 and rows[0].quantity == 2


def test_bad_first_duplicate_loses_both(spark, json_dir):
    """Dedup runs before the expectations: quantity 0 wins the key, then is dropped."""
    rows, _ = silver(spark, json_dir([row(quantity=0), row(quantity=2)]))
    assert rows == []


def test_metrics_count_failures_per_expectation(spark, json_dir):
    path = json_dir([row(), row(order_id="o2", quantity=0), row(order_id="o3", price=None),
                     row(order_id="o4", order_date="invalid-date")])
    rows, metrics = silver(spark, path)
    assert len(rows) == 1
    m = metrics.get
    assert m["total_records"] == 4
    assert m["failed_valid_quantity"] == 1
    assert m["failed_valid_price"] == 1
    assert m["failed_valid_order_date"] == 1
    assert m["failed_valid_order_date_format"] == 1
    assert m["failed_valid_order_id"] == 0


def test_stream_matches_batch_and_bad_first_duplicate(spark, json_dir, tmp_path):
    from strata.streaming.runner import StreamLayout, run_orders_increment
    src = tmp_path / "orders_raw"
    # batch 1: the bad duplicate arrives first; batch 2: the good copy and a new key
    json_dir([row(quantity=0)], name="orders_raw/a")
    layout = StreamLayout(str(tmp_path / "pipe"))
    cfg = CFG.with_overrides(max_files_per_trigger=1)
    r1 = run_orders_increment(spark, cfg, f"{src}/*", layout, FIRST_ARRIVAL)
    json_dir([row(quantity=2), row(order_id="o9")], name="orders_raw/b")
    r2 = run_orders_increment(spark, cfg, f"{src}/*", layout, FIRST_ARRIVAL)
    out = spark.read.parquet(layout.table("silver_orders")).collect()
    assert [r.order_id for r in out] == ["o9"]
    assert r1["bronze_rows"] == 1 and r2["bronze_rows"] == 2
    assert r1["expectations"]["failed_valid_quantity"] == 1


def test_expectation_filter_not_pushed_below_dedup(spark, json_dir):
    """Only key predicates may move below the dedup aggregate."""
    path = json_dir([row(quantity=0), row(quantity=2)])
    df, _ = silver_orders(bronze_orders(spark, CFG, path, stream=False), CFG, observe=False)
    assert df.filter(F.col("quantity") > 0).count() == 0
