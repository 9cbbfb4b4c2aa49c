"""DS-3, DS-5, DS-6 kept up to date from partial sums instead of all history.

An update reads the silver batches added since the last one and appends, per group (a
customer; a product with its name and category), partial sums, minima and maxima, and
counts of values not seen before (a customer's orders, products and categories; a
product's customers and orders). The values seen are a table of their own, in buckets
of the group's hash, of which an update reads those it touches. An update goes through
the buckets in passes of about ``PASS_ROWS`` values, met and seen, so that what is
shuffled at a time doesn't grow with history. A gold table is the merge of its partial
rows: as many as groups times updates that met them, until ``compact_state`` merges them.

Both tables are snapshot tables (``sinks/snapshots.py``) with the silver version as
batch id. The partial rows are published before the values they counted as new, so an
update that failed anywhere is repeated whole and counts nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import PipelineConfig
from strata.plans import orders as OR
from strata.session import shuffles_freed
from strata.sinks import snapshots
from strata.sinks.writers import clustered

BUCKETS = 64
#: Values, met and seen, of a pass: about 2 GB shuffled.
PASS_ROWS = 32_000_000


@dataclass(frozen=True)
class State:
    """Partial sums by ``keys``; ``distinct``: output column -> the column whose values are counted."""
    name: str
    keys: tuple[str, ...]
    distinct: dict[str, str]


CUSTOMER = State("customer", ("customer_id",), {"total_orders": "order_id", "unique_products_purchased": "product_id", "categories_shopped": "category"})
PRODUCT = State("product", ("product_id", "product_name", "category"), {"unique_customers": "customer_id", "unique_orders": "order_id"})
STATES = (CUSTOMER, PRODUCT)

# How partial columns of one group merge.
_SUMS = ("lines", "quantity", "revenue", "revenue_lines", "quantity_lines", "price_sum", "price_lines")
_MINIMA, _MAXIMA = ("first_order_date", "min_price"), ("latest_order_date", "max_price")


def _bucket(state: State) -> Column:
    return F.pmod(F.xxhash64(*state.keys), F.lit(BUCKETS)).cast("int")


def _values(rows: DataFrame, state: State) -> DataFrame:
    """(keys, kind, value, bucket): the values of each group, as often as they occur."""
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value")) for kind, c in state.distinct.items()])
    return rows.select(*state.keys, F.inline(pairs)).filter("value IS NOT NULL").withColumn("bucket", _bucket(state))


def _unseen(met: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The different values met that aren't among the seen ones: one aggregate over both,
    which needs neither a sort nor a null-safe join."""
    columns = met.columns
    if seen is None:
        return met.distinct()
    both = met.withColumn("old", F.lit(0)).unionByName(seen.select(*columns).withColumn("old", F.lit(1)))
    return both.groupBy(*columns).agg(F.max("old").alias("old")).filter("old = 0").drop("old")


def _partial(rows: DataFrame, first: DataFrame, state: State) -> DataFrame:
    """Partial sums of the rows with the counts of their first-seen values, in one aggregate."""
    values = rows.select(*state.keys, F.lit(True).alias("line"), "quantity", "total_item_price", "price", "order_date")
    return values.unionByName(first.select(*state.keys, "kind"), allowMissingColumns=True).groupBy(*state.keys).agg(
        F.count("line").alias("lines"), F.sum("quantity").alias("quantity"), F.sum("total_item_price").alias("revenue"),
        F.count("total_item_price").alias("revenue_lines"), F.count("quantity").alias("quantity_lines"), F.sum("price").alias("price_sum"),
        F.count("price").alias("price_lines"), *[F.count_if(F.col("kind") == kind).alias(kind) for kind in state.distinct],
        F.min("order_date").alias("first_order_date"), F.min("price").alias("min_price"),
        F.max("order_date").alias("latest_order_date"), F.max("price").alias("max_price"))


def _merge(partial: DataFrame, state: State) -> DataFrame:
    return partial.groupBy(*state.keys).agg(*[F.sum(c).alias(c) for c in (*_SUMS, *state.distinct)],
                                            *[F.min(c).alias(c) for c in _MINIMA], *[F.max(c).alias(c) for c in _MAXIMA])


def _paths(root: str, state: State) -> tuple[str, str]:
    return f"{root}/_state_{state.name}_partials", f"{root}/_state_{state.name}_values"


def _applied(spark: SparkSession, path: str) -> int:
    return max((p.last_id for p in snapshots.snapshot(spark, path)[1] if p.kind == snapshots.MARK), default=0)


def _passes(values: int) -> list[range]:
    """The buckets in ranges, as many as that number of values takes."""
    n = min(BUCKETS, max(1, -(-values // PASS_ROWS)))
    ends = [BUCKETS * i // n for i in range(n + 1)]
    return [range(a, b) for a, b in zip(ends, ends[1:])]


def _in(buckets: range, bucket: Column) -> Column:
    return bucket.between(buckets[0], buckets[-1]) if len(buckets) < BUCKETS else F.lit(True)


def _rows(spark: SparkSession, path: str) -> int:
    return sum(p.rows for p in snapshots.snapshot(spark, path)[1])


def update_state(spark: SparkSession, silver_path: str, root: str, state: State) -> int:
    """Fold the silver batches that aren't in the state yet; returns how many there were."""
    partials, values = _paths(root, state)
    version, done = snapshots.latest_version(spark, silver_path), _applied(spark, values)
    new = [p for p in snapshots.added_since(spark, silver_path, done) if p.added <= version]
    if not new:
        return 0
    rows = snapshots.read_pieces(spark, silver_path, new)
    seen, known = None, 0
    if done:
        touched = [r["bucket"] for r in rows.select(_bucket(state).alias("bucket")).distinct().collect()]  # BUCKETS at most
        seen, known = snapshots.read(spark, values).filter(F.col("bucket").isin(touched)), _rows(spark, values)
    counted = version <= _applied(spark, partials)  # by an update that failed after them
    with shuffles_freed(spark):
        # Values are found once and kept by bucket (else each task would write a file to each bucket); counted from there.
        for i, buckets in enumerate(_passes(sum(p.rows for p in new) * len(state.distinct) + known)):
            some, met = rows.filter(_in(buckets, _bucket(state))), _in(buckets, F.col("bucket"))
            unseen = _unseen(_values(some, state), None if seen is None else seen.filter(met))
            first = snapshots.stage_batch(clustered(unseen, state.keys, ["bucket"]), values, version, partition_cols=["bucket"], more=i > 0)
            if not counted:
                sums = snapshots.stage_batch(_partial(some, first.filter(met), state), partials, version, more=i > 0)
    if not counted:
        snapshots.append_batch(sums, partials, version, staged=True)
    snapshots.append_batch(first, values, version, partition_cols=["bucket"], staged=True)
    return len(new)


def compact_state(spark: SparkSession, root: str, state: State) -> None:
    """Merge the partial rows of all updates, and the buckets' files of seen values."""
    partials, values = _paths(root, state)
    with shuffles_freed(spark):
        snapshots.rewrite(_merge(snapshots.read(spark, partials), state), partials)
        snapshots.rewrite(snapshots.read(spark, values), values, ["bucket"], state.keys, [_in(b, F.col("bucket")) for b in _passes(_rows(spark, values))])


def merged(spark: SparkSession, root: str, state: State) -> DataFrame:
    """One row a group over all updates."""
    return _merge(snapshots.read(spark, _paths(root, state)[0]), state)


def customer_insights(spark: SparkSession, root: str, cfg: PipelineConfig, as_of=None) -> DataFrame:
    """DS-5 from the state."""
    s = merged(spark, root, CUSTOMER).select(
        "customer_id", *CUSTOMER.distinct, F.col("revenue").alias("lifetime_value"), (F.col("revenue") / F.col("revenue_lines")).alias("avg_order_value"),
        F.col("quantity").alias("total_items_purchased"), "latest_order_date", "first_order_date", F.col("lines").alias("total_line_items"))
    return OR.customer_insight_columns(s, cfg, as_of)


def product_performance(spark: SparkSession, root: str, cfg: PipelineConfig) -> DataFrame:
    """DS-6 from the state."""
    s = merged(spark, root, PRODUCT).select(
        *PRODUCT.keys, F.col("quantity").alias("total_units_sold"), F.col("revenue").alias("total_revenue"), *PRODUCT.distinct,
        (F.col("price_sum") / F.col("price_lines")).alias("avg_price"), "min_price", "max_price",
        (F.col("quantity") / F.col("quantity_lines")).alias("avg_quantity_per_order"), "latest_order_date", "first_order_date")
    return OR.product_performance_columns(s)
