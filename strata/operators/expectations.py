"""DQ-1..6: named row-level expectations that warn, drop or fail, with metrics.

All expectations of a table are evaluated in one pass: a single ``observe``
carries one ``count_if`` per expectation (DQ-4 metrics), and one combined
filter drops or fails rows. A NULL predicate counts as failed, as in a filter.
Works unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.config import PipelineConfig

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    mode: str = DROP

    def passed(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect(name: str, predicate: str) -> Expectation:
    """DQ-1: record the metric, keep every row."""
    return Expectation(name, predicate, WARN)


def expect_or_drop(name: str, predicate: str) -> Expectation:
    """DQ-2: drop rows that fail."""
    return Expectation(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str) -> Expectation:
    """DQ-3: fail the run on the first failing row."""
    return Expectation(name, predicate, FAIL)


def _metric_columns(expectations) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("total_records")]
    for e in expectations:
        cols.append(F.count_if(~e.passed()).alias(f"failed_{e.name}"))
    return cols


def apply_expectations(df: DataFrame, expectations, dataset: str = "dataset",
                       observe: bool = True, materialize: bool = False):
    """Apply expectations; returns ``(df, metrics)``.

    ``metrics`` is an ``Observation`` for a batch frame (filled after the first
    action), or the observation name for a stream (read it from
    ``query.lastProgress['observedMetrics']``), or None when not observed.

    A fail-mode check covers the rows that reach it: a filter applied later
    to the returned frame may be pushed below the check by the optimizer. The
    pipelines write each checked table right away; for ad-hoc use,
    ``materialize=True`` checkpoints the checked batch frame (reliable
    checkpoint in the shared folder), so every row is checked once.
    """
    expectations = list(expectations)
    if not expectations:
        return df, None
    metrics = None
    if observe:
        if df.isStreaming:
            metrics = f"dq_{dataset}"
            df = df.observe(metrics, *_metric_columns(expectations))
        else:
            metrics = Observation(f"dq_{dataset}")
            df = df.observe(metrics, *_metric_columns(expectations))
    keep = None
    # Fail conditions come first: a row that a drop expectation removes still fails.
    for e in sorted(expectations, key=lambda e: e.mode != FAIL):
        if e.mode == WARN:
            continue
        if e.mode == DROP:
            cond = e.passed()
        elif e.mode == FAIL:
            msg = f"Expectation '{e.name}' failed on dataset '{dataset}': {e.predicate}"
            # Filter form: it cannot be pruned away like an unused guard column.
            cond = e.passed() | F.raise_error(F.lit(msg)).cast("boolean")
        else:
            raise ValueError(f"Unknown expectation mode: {e.mode}")
        keep = cond if keep is None else keep & cond
    if keep is not None:
        df = df.filter(keep)
    if materialize and not df.isStreaming:
        from strata.session import shared_dir
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return df, metrics


def metrics_dict(metrics) -> dict:
    """Observation -> {'total_records': n, 'failed_<name>': n, ...}."""
    return dict(metrics.get) if isinstance(metrics, Observation) else {}


def expectation_metrics(df: DataFrame, expectations, dataset: str = "dataset") -> DataFrame:
    """DQ-4 as a table: one row per expectation with total/passed/failed counts.

    One distributed aggregate (partial counts per task, one row to combine),
    then the single row is unpivoted into one row per expectation.
    """
    expectations = list(expectations)
    agg = df.agg(F.count(F.lit(1)).alias("total_records"),
                 *[F.count_if(e.passed()).alias(f"p{i}") for i, e in enumerate(expectations)])
    rows = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.mode).alias("mode"),
                     F.col(f"p{i}").alias("passed_records"))
            for i, e in enumerate(expectations)]
    out = agg.select("total_records", F.explode(F.array(*rows)).alias("m"))
    return out.select(
        F.lit(dataset).alias("dataset"),
        F.col("m.expectation").alias("expectation"),
        F.col("m.mode").alias("mode"),
        F.col("total_records"),
        F.col("m.passed_records").alias("passed_records"),
        (F.col("total_records") - F.col("m.passed_records")).alias("failed_records"),
    )


def check_dataset(df: DataFrame, name: str, predicate: str, mode: str = FAIL) -> bool:
    """DQ-6: a dataset-level check such as ``count(*) > 0``, one aggregate row."""
    ok = bool(df.agg(F.coalesce(F.expr(predicate), F.lit(False)).alias("ok")).first()["ok"])
    if not ok and mode == FAIL:
        raise ValueError(f"Dataset expectation '{name}' failed: {predicate}")
    return ok


# The expectation predicates of the pipelines.
def silver_orders_expectations(cfg: PipelineConfig) -> list[Expectation]:
    return [
        expect_or_drop("valid_order_id", "order_id IS NOT NULL AND length(trim(order_id)) > 0"),
        expect_or_drop("valid_customer_id", "customer_id IS NOT NULL AND length(trim(customer_id)) > 0"),
        expect_or_drop("valid_product_id", "product_id IS NOT NULL AND length(trim(product_id)) > 0"),
        expect_or_drop("valid_order_date", "order_date IS NOT NULL AND length(order_date) = 10"),
        expect_or_drop("valid_quantity", f"quantity > 0 AND quantity <= {cfg.max_quantity}"),
        expect_or_drop("valid_price", f"price > 0 AND price <= {cfg.max_price}"),
        expect_or_drop("valid_order_date_format", "order_date RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"),
    ]


SILVER_CUSTOMERS_EXPECTATIONS = [expect_or_drop("valid_customer_record", "customer_id IS NOT NULL")]

SILVER_ACTIVITY_EXPECTATIONS = [
    expect_or_drop("valid_customer_id", "customer_id IS NOT NULL"),
    expect_or_drop("valid_timestamp", "timestamp IS NOT NULL AND timestamp != 'invalid-timestamp'"),
    expect_or_drop("valid_page_views", "page_views >= 0"),
    expect_or_drop("valid_cart_adds", "cart_adds >= 0"),
    expect_or_drop("valid_purchases", "purchases >= 0"),
]

SILVER_PROFILE_EXPECTATIONS = [
    expect_or_drop("valid_customer_profile_id", "customer_id IS NOT NULL"),
    expect_or_drop("valid_signup_date", "signup_date IS NOT NULL"),
]

SAMPLE_SILVER_ORDERS_EXPECTATIONS = [
    expect_or_drop("valid_order_date", "order_date IS NOT NULL AND length(order_date) = 10"),
    expect_or_drop("valid_product_id", "product_id IS NOT NULL"),
    expect_or_drop("valid_quantity", "quantity > 0"),
]


def expectation_catalogue(cfg: PipelineConfig) -> dict[str, dict[str, list[tuple[str, str]]]]:
    """DQ-5: the named catalogue by layer and group (business rules take config)."""
    return {
        "bronze": {
            "not_null_checks": [
                ("valid_order_id", "order_id IS NOT NULL AND length(trim(order_id)) > 0"),
                ("valid_customer_id", "customer_id IS NOT NULL AND length(trim(customer_id)) > 0"),
                ("valid_product_id", "product_id IS NOT NULL AND length(trim(product_id)) > 0"),
            ],
            "format_checks": [
                ("valid_order_date", "order_date IS NOT NULL AND length(order_date) = 10"),
                ("valid_order_date_format", "order_date RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"),
            ],
        },
        "silver": {
            "business_rules": [
                ("valid_quantity", f"quantity > 0 AND quantity <= {cfg.max_quantity}"),
                ("valid_price", f"price > 0 AND price <= {cfg.max_price}"),
            ],
            "critical_checks": [
                ("critical_data_quality", "count(*) > 0"),
            ],
        },
    }


def catalogue_expectations(cfg: PipelineConfig, layer: str, group: str,
                           mode: str = DROP) -> list[Expectation]:
    return [Expectation(n, p, mode) for n, p in expectation_catalogue(cfg)[layer][group]]
