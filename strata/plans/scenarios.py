"""Registered queries of runs over time: several updates, streams that change, planted defects.

Each scenario writes its inputs under the shared folder from the whole given tables and
returns a batch read of what it built.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.dates import parse_date
from strata.operators import expectations as E
from strata.operators.dedup import VALID_FIRST
from strata.plans import gold_state as GS
from strata.plans import orders as OR
from strata.plans import sketches as SK
from strata.plans.oracle_sql import ORACLE_RAW_ACTIVITY, ORACLE_RAW_ORDERS, ORACLE_RAW_PROFILES, silver_orders_cte
from strata.plans.query_inputs import ORDERS_AS_OF, QUERY_CFG, json_orders, orders_first_and_rest, public
from strata.session import new_work_path, shuffles_freed
from strata.sinks import snapshots
from strata.sinks.writers import json_files, write_hand_over, write_json
from strata.sources import bindings as B
from strata.sources.evolving import RESCUED, read_evolving, run_evolving
from strata.sources.readers import bronze_customer_activity
from strata.streaming import runner
from strata.streaming.late import run_with_late_rows
from strata.streaming.metrics import batch_metrics
from strata.streaming.runner import StreamLayout, run_orders_increment

# ---------------------------------------------------------------- gold from partial sums


def _three_updates(spark, sf_dir, state) -> str:
    """Silver in three batches, each folded into the state; after the second the state is compacted."""
    root = new_work_path(spark, f"gold_state_{state.name}")
    part = F.pmod(F.xxhash64(*OR.ORDER_KEYS), F.lit(3))
    for i in range(3):
        # A batch has all rows of its keys, so each is made by itself: a third is shuffled at a time, and silver written once.
        bronze = B.as_bronze(B.raw_orders(spark, sf_dir).filter(part == i))
        silver = public(OR.silver_orders(bronze, QUERY_CFG, observe=False)[0])
        with shuffles_freed(spark):
            snapshots.append_batch(silver, f"{root}/silver_orders", i, date_col="order_date")
        GS.update_state(spark, f"{root}/silver_orders", root, state)
        if i == 1:
            GS.compact_state(spark, root, state)
    return root


def q_gold_customer_insights_incremental(spark, sf_dir):
    """DS-5 merged from the partial sums of three updates; equals the full table."""
    return public(GS.customer_insights(spark, _three_updates(spark, sf_dir, GS.CUSTOMER), QUERY_CFG, ORDERS_AS_OF))


def q_silver_customers_incremental(spark, sf_dir):
    """DS-3 from the same state."""
    insights = GS.customer_insights(spark, _three_updates(spark, sf_dir, GS.CUSTOMER), QUERY_CFG, ORDERS_AS_OF)
    return public(OR.silver_customers_from_insights(insights, QUERY_CFG))


def q_gold_product_performance_incremental(spark, sf_dir):
    """DS-6 merged from the partial sums of three updates."""
    return public(GS.product_performance(spark, _three_updates(spark, sf_dir, GS.PRODUCT), QUERY_CFG))


# ---------------------------------------------------------------- streams that change


def _two_runs(spark, sf_dir, label, between=None, after=None):
    """Run 1: the row that is kept of each key; run 2: its other rows. Returns the layout."""
    rows = B.row_count(spark, sf_dir, "lineitem")
    root = new_work_path(spark, label)
    layout = StreamLayout(root)
    first, rest = orders_first_and_rest(spark, sf_dir)
    with shuffles_freed(spark):
        files = write_hand_over(first, f"{root}/orders_raw/run1", rows, 4)
    cfg = QUERY_CFG.with_overrides(max_files_per_trigger=-(-files // 2))
    run_orders_increment(spark, cfg, f"{root}/orders_raw/*", layout)
    if between:
        between(cfg, layout)
    with shuffles_freed(spark):
        write_hand_over(rest, f"{root}/orders_raw/run2", rest.count(), 2)
    run_orders_increment(spark, cfg, f"{root}/orders_raw/*", layout)
    if after:
        after(cfg, layout)
    return layout


def q_stream_silver_orders_regrown(spark, sf_dir):
    """STR-2: between the runs the stream moves to a state of four times as many
    partitions; the second run's duplicates must still all be rejected."""
    def grow(cfg, layout):
        runner.regrow_state(spark, cfg, layout, runner.ORDERS, 4 * runner.state_partitions(spark, layout, runner.ORDERS))
    layout = _two_runs(spark, sf_dir, "orders_regrown", between=grow)
    return public(snapshots.read(spark, layout.table("silver_orders")).select(*OR.SILVER_ORDERS_COLUMNS))


def q_stream_silver_orders_compacted(spark, sf_dir):
    """SNK-3/4: dates up to 1995 are compacted between the runs, all dates up to 1997 after them."""
    def pack(through):
        def compact(cfg, layout):
            with shuffles_freed(spark):
                snapshots.compact_dates(spark, layout.table("silver_orders"), through, "order_date", ["order_id"])
        return compact
    layout = _two_runs(spark, sf_dir, "orders_compacted", between=pack("1995-12-31"), after=pack("1997-06-30"))
    return public(snapshots.read(spark, layout.table("silver_orders")).select(*OR.SILVER_ORDERS_COLUMNS))


def q_stream_expect_metrics(spark, sf_dir):
    """DQ-4 on a stream: the recorded rows of all its micro-batches, summed up."""
    layout = _two_runs(spark, sf_dir, "orders_batch_metrics")
    return batch_metrics(spark, layout.table("_dq_batches")).groupBy("dataset", "expectation").agg(
        F.sum("total_records").alias("total_records"), F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))


SQL_STREAM_EXPECT_METRICS = f"""WITH {silver_orders_cte(QUERY_CFG.max_quantity, QUERY_CFG.max_price)},
m AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE order_id IS NOT NULL AND length(trim(order_id)) > 0) AS p0,
  count(*) FILTER (WHERE customer_id IS NOT NULL AND length(trim(customer_id)) > 0) AS p1,
  count(*) FILTER (WHERE product_id IS NOT NULL AND length(trim(product_id)) > 0) AS p2,
  count(*) FILTER (WHERE order_date IS NOT NULL AND length(CAST(order_date AS VARCHAR)) = 10) AS p3,
  count(*) FILTER (WHERE quantity > 0 AND quantity <= {QUERY_CFG.max_quantity}) AS p4,
  count(*) FILTER (WHERE price > 0 AND price <= {QUERY_CFG.max_price}) AS p5,
  count(*) FILTER (WHERE regexp_matches(CAST(order_date AS VARCHAR), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) AS p6
  FROM ranked_orders WHERE rn = 1),
e AS (SELECT n, unnest(['valid_order_id', 'valid_customer_id', 'valid_product_id', 'valid_order_date', 'valid_quantity', 'valid_price',
  'valid_order_date_format']) AS expectation, unnest([p0, p1, p2, p3, p4, p5, p6]) AS p FROM m)
SELECT 'silver_orders' AS dataset, expectation, n AS total_records, p AS passed_records, n - p AS failed_records FROM e"""


def q_sample_bronze_evolving(spark, sf_dir):
    """SRC-4/5: the second run's files have a new field; earlier rows get null for it."""
    root = new_work_path(spark, "orders_evolving")
    raw = json_orders(B.raw_orders(spark, sf_dir))
    even = F.col("order_id") % 2 == 0
    rows = B.row_count(spark, sf_dir, "lineitem")
    where = (f"{root}/orders_raw/*", f"{root}/bronze_orders", f"{root}/checkpoint")
    for i, part in enumerate((raw.filter(even).drop("status", "category"), raw.filter(~even)), start=1):
        with shuffles_freed(spark):
            write_hand_over(part, f"{root}/orders_raw/run{i}", rows, 2)
        run_evolving(spark, *where)
    return read_evolving(spark, *where[1:]).drop(RESCUED)


SQL_SAMPLE_BRONZE_EVOLVING = f"""SELECT CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN NULL ELSE category END AS category,
  CAST(customer_id AS BIGINT) AS customer_id, order_date, CAST(order_id AS BIGINT) AS order_id, price, CAST(product_id AS BIGINT) AS product_id,
  product_name, CAST(quantity AS BIGINT) AS quantity, CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN NULL ELSE status END AS status
FROM ({ORACLE_RAW_ORDERS})"""


def q_stream_late_activity(spark, sf_dir):
    """STR-3: the second run brings a third of the sessions; those ten days behind the
    first run's last one are late. Rows by day, on time and late."""
    root = new_work_path(spark, "late_activity")
    raw = B.raw_activity(spark, sf_dir)
    third = F.col("session_id").cast("long") % 3 == 0
    files = json_files(B.row_count(spark, sf_dir, "events"), 2)
    tables = f"{root}/activity", f"{root}/late_activity"
    for i, rows in enumerate((raw.filter(~third), raw.filter(third)), 1):
        write_json(rows, f"{root}/activity_raw/run{i}", num_files=files)
        stream = bronze_customer_activity(spark, QUERY_CFG, f"{root}/activity_raw/*").withColumn("event_time", F.try_to_timestamp("timestamp"))
        run_with_late_rows(spark, stream, "event_time", "10 days", *tables, f"{root}/checkpoint")
    schema = stream.schema
    both = [snapshots.read(spark, t, schema).withColumn("late", F.lit(late)) for t, late in zip(tables, (False, True))]
    return both[0].unionByName(both[1]).groupBy(F.to_date("event_time").alias("activity_date")).agg(
        F.count_if(~F.col("late")).alias("on_time_rows"), F.count_if(F.col("late")).alias("late_rows"))


SQL_STREAM_LATE_ACTIVITY = f"""WITH a AS (SELECT CAST(session_id AS BIGINT) % 3 = 0 AS second, TRY_CAST("timestamp" AS TIMESTAMP) AS t FROM ({ORACLE_RAW_ACTIVITY})),
mark AS (SELECT max(t) - INTERVAL 10 DAY AS m FROM a WHERE NOT second),
r AS (SELECT CAST(t AS DATE) AS activity_date, coalesce(second AND t < m, false) AS late FROM a, mark)
SELECT activity_date, count(*) FILTER (WHERE NOT late) AS on_time_rows, count(*) FILTER (WHERE late) AS late_rows FROM r GROUP BY activity_date"""


# ---------------------------------------------------------------- sketches


def q_customer_sketch_roll_up(spark, sf_dir):
    """AGG-3: yearly distinct customers and orders from daily sketches, beside the exact counts."""
    silver = OR.silver_orders(B.as_bronze(B.raw_orders(spark, sf_dir)), QUERY_CFG, observe=False)[0]
    path = new_work_path(spark, "customer_sketches")
    SK.daily_customer_sketches(silver).write.parquet(f"{path}/daily")
    rolled = SK.roll_up(spark.read.parquet(f"{path}/daily"), "order_year")
    exact = silver.groupBy("order_year").agg(F.count_distinct("customer_id").alias("customers"), F.count_distinct("order_id").alias("orders"))
    def near(approx, count):
        return F.abs(F.col(approx) - F.col(count)) <= 0.05 * F.col(count)
    return exact.join(rolled, "order_year").select("order_year", "lines", "customers", "orders", near("approx_customers", "customers").alias("customers_near"),
                                                   near("approx_orders", "orders").alias("orders_near"))


_SO = silver_orders_cte(QUERY_CFG.max_quantity, QUERY_CFG.max_price)
SQL_CUSTOMER_SKETCH_ROLL_UP = f"""WITH {_SO} SELECT order_year, count(*) AS lines, count(DISTINCT customer_id) AS customers,
  count(DISTINCT order_id) AS orders, true AS customers_near, true AS orders_near FROM silver_orders GROUP BY order_year"""


# ---------------------------------------------------------------- planted defects

ORDERS_WITH_DEFECTS = f"""SELECT CASE WHEN CAST(order_id AS BIGINT) % 101 = 3 THEN NULL WHEN CAST(order_id AS BIGINT) % 101 = 5 THEN '  ' ELSE order_id END AS order_id,
  CASE WHEN CAST(customer_id AS BIGINT) % 97 = 1 THEN NULL WHEN CAST(customer_id AS BIGINT) % 97 = 2 THEN '' ELSE customer_id END AS customer_id,
  order_date, product_id, product_name, category,
  CAST(CASE quantity % 11 WHEN 2 THEN 0 WHEN 3 THEN 20000 ELSE quantity END AS INTEGER) AS quantity,
  CASE CAST(order_id AS BIGINT) % 83 WHEN 4 THEN CAST(0 AS DOUBLE) WHEN 5 THEN CAST(200000 AS DOUBLE) ELSE price END AS price, status
FROM ({ORACLE_RAW_ORDERS})"""


def _defective_clean(spark, sf_dir):
    return OR.clean_orders(B.as_bronze(B.defective_orders(B.raw_orders(spark, sf_dir))), QUERY_CFG)


def q_expect_metrics_defects(spark, sf_dir):
    """DQ-4 over inputs with a planted defect for every predicate of all three silver tables."""
    parts = [E.expectation_metrics(_defective_clean(spark, sf_dir), E.silver_orders_expectations(QUERY_CFG), "silver_orders"),
             E.expectation_metrics(B.defective_activity(B.raw_activity(spark, sf_dir)), E.SILVER_ACTIVITY_EXPECTATIONS, "silver_customer_activity"),
             E.expectation_metrics(B.defective_profiles(B.raw_profiles(spark, sf_dir)), E.SILVER_PROFILE_EXPECTATIONS, "silver_customer_profile")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_expect_warn_defects(spark, sf_dir):
    """DQ-1: warn-mode expectations count failures and keep every row."""
    warned = [E.expect(e.name, e.predicate) for e in E.silver_orders_expectations(QUERY_CFG)]
    rows = _defective_clean(spark, sf_dir)
    kept = E.apply_expectations(rows, warned, "silver_orders", observe=False)[0].agg(F.count(F.lit(1)).alias("rows_kept"))
    return E.expectation_metrics(rows, warned, "silver_orders").crossJoin(F.broadcast(kept))  # one row


def q_catalogue_checks(spark, sf_dir):
    """DQ-5, DQ-6: every group of the catalogue over the defective orders; dataset checks by an aggregate."""
    rows, out = _defective_clean(spark, sf_dir), None
    for layer, groups in E.expectation_catalogue(QUERY_CFG).items():
        for group, checks in groups.items():
            if group == "critical_checks":
                found = rows.agg(F.count(F.lit(1)).alias("total_records"), *[F.expr(p).alias(n) for n, p in checks]).select(
                    F.explode(F.array(*[F.struct(F.lit(n).alias("expectation"), F.when(F.col(n), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("failed_records"))
                                        for n, _ in checks])).alias("m"), "total_records").select("m.expectation", "total_records", "m.failed_records")
            else:
                found = E.expectation_metrics(rows, E.catalogue_expectations(QUERY_CFG, layer, group), group).select("expectation", "total_records", "failed_records")
            found = found.select(F.lit(layer).alias("layer"), F.lit(group).alias("check_group"), "*")
            out = found if out is None else out.unionByName(found)
    return out


def q_silver_orders_first_valid(spark, sf_dir):
    """DS-2 with the first valid row of each key: bad first duplicates don't lose good ones."""
    bronze = B.as_bronze(B.defective_orders(B.raw_orders(spark, sf_dir)))
    return public(OR.silver_orders(bronze, QUERY_CFG, VALID_FIRST, observe=False)[0])


_CHECKS = {  # predicates over parsed dates, by expectation
    "valid_order_id": "order_id IS NOT NULL AND length(trim(order_id)) > 0",
    "valid_customer_id": "customer_id IS NOT NULL AND length(trim(customer_id)) > 0",
    "valid_product_id": "product_id IS NOT NULL AND length(trim(product_id)) > 0",
    "valid_order_date": "order_date IS NOT NULL AND length(CAST(order_date AS VARCHAR)) = 10",
    "valid_quantity": f"quantity > 0 AND quantity <= {QUERY_CFG.max_quantity}",
    "valid_price": f"price > 0 AND price <= {QUERY_CFG.max_price}",
    "valid_order_date_format": "regexp_matches(CAST(order_date AS VARCHAR), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')",
}
_DEFECTIVE = f"d AS (SELECT * REPLACE (CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date) FROM ({ORDERS_WITH_DEFECTS}))"
_ACTIVITY_CHECKS = {"valid_customer_id": "customer_id IS NOT NULL AND session % 71 <> 1", "valid_timestamp": "\"timestamp\" <> 'invalid-timestamp'",
                    "valid_page_views": "page_views >= 0", "valid_cart_adds": "session % 73 <> 2", "valid_purchases": "session % 79 <> 3"}
_PROFILE_CHECKS = {"valid_customer_profile_id": "customer_id % 61 <> 7", "valid_signup_date": "signup_date IS NOT NULL"}


def _metrics_sql(dataset: str, checks: dict[str, str], source: str, mode: str = "drop") -> str:
    return " UNION ALL ".join(f"SELECT '{dataset}' AS dataset, '{n}' AS expectation, '{mode}' AS mode, count(*) AS total_records, "
                              f"count(*) FILTER (WHERE {p}) AS passed_records, count(*) - count(*) FILTER (WHERE {p}) AS failed_records FROM {source}"
                              for n, p in checks.items())


SQL_EXPECT_METRICS_DEFECTS = (f"WITH {_DEFECTIVE}, a AS (SELECT *, CAST(session_id AS BIGINT) AS session FROM ({ORACLE_RAW_ACTIVITY})), p AS ({ORACLE_RAW_PROFILES}) "
                              + " UNION ALL ".join([_metrics_sql("silver_orders", _CHECKS, "d"), _metrics_sql("silver_customer_activity", _ACTIVITY_CHECKS, "a"),
                                                    _metrics_sql("silver_customer_profile", _PROFILE_CHECKS, "p")]))
SQL_EXPECT_WARN_DEFECTS = (f"WITH {_DEFECTIVE}, m AS ({_metrics_sql('silver_orders', _CHECKS, 'd', 'warn')}) "
                           "SELECT m.*, (SELECT count(*) FROM d) AS rows_kept FROM m")
_GROUPS = [("bronze", "not_null_checks", ["valid_order_id", "valid_customer_id", "valid_product_id"]),
           ("bronze", "format_checks", ["valid_order_date", "valid_order_date_format"]), ("silver", "business_rules", ["valid_quantity", "valid_price"])]
SQL_CATALOGUE_CHECKS = f"WITH {_DEFECTIVE} " + " UNION ALL ".join(
    [f"SELECT '{layer}' AS layer, '{group}' AS check_group, '{n}' AS expectation, count(*) AS total_records, count(*) - count(*) FILTER (WHERE {_CHECKS[n]}) AS failed_records FROM d"
     for layer, group, names in _GROUPS for n in names]
    + ["SELECT 'silver', 'critical_checks', 'critical_data_quality', count(*), CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM d"])
_VALID = " AND ".join(f"coalesce({p}, false)" for p in _CHECKS.values())
SQL_SILVER_ORDERS_FIRST_VALID = (
    "WITH " + _SO.replace(f"raw_orders AS ({ORACLE_RAW_ORDERS})", f"raw_orders AS ({ORDERS_WITH_DEFECTS})").replace(
        "PARTITION BY order_id, product_id ORDER BY", f"PARTITION BY order_id, product_id ORDER BY ({_VALID}) DESC,")
    + " SELECT * FROM silver_orders")


QUERIES = {
    "gold_customer_insights_incremental": q_gold_customer_insights_incremental,
    "silver_customers_incremental": q_silver_customers_incremental,
    "gold_product_performance_incremental": q_gold_product_performance_incremental,
    "stream_silver_orders_regrown": q_stream_silver_orders_regrown,
    "stream_silver_orders_compacted": q_stream_silver_orders_compacted,
    "stream_expect_metrics": q_stream_expect_metrics,
    "sample_bronze_evolving": q_sample_bronze_evolving,
    "stream_late_activity": q_stream_late_activity,
    "customer_sketch_roll_up": q_customer_sketch_roll_up,
    "expect_metrics_defects": q_expect_metrics_defects,
    "expect_warn_defects": q_expect_warn_defects,
    "catalogue_checks": q_catalogue_checks,
    "silver_orders_first_valid": q_silver_orders_first_valid,
}
ORACLE = {
    "stream_expect_metrics": SQL_STREAM_EXPECT_METRICS,
    "sample_bronze_evolving": SQL_SAMPLE_BRONZE_EVOLVING,
    "stream_late_activity": SQL_STREAM_LATE_ACTIVITY,
    "customer_sketch_roll_up": SQL_CUSTOMER_SKETCH_ROLL_UP,
    "expect_metrics_defects": SQL_EXPECT_METRICS_DEFECTS,
    "expect_warn_defects": SQL_EXPECT_WARN_DEFECTS,
    "catalogue_checks": SQL_CATALOGUE_CHECKS,
    "silver_orders_first_valid": SQL_SILVER_ORDERS_FIRST_VALID,
}
