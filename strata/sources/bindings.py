"""Raw inputs derived from the driver's TPC-H-style tables.

The three raw datasets of the pipelines (orders, customer activity, customer
profiles) are built from ``lineitem/orders/part``, ``events`` and ``customer``
with defects planted by arithmetic on keys, so an SQL oracle can repeat them.
Only the columns a binding needs are read (the parquet scan prunes the rest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table (from the file footers), to size what is written from it."""
    return table(spark, sf_dir, name).count()


def _null_when(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_raw: one row per line item, typed as the raw JSON schema."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    # Join strategy is left to Catalyst/AQE: a side is broadcast only when its
    # measured size is under the broadcast threshold, else both sides shuffle.
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    j = j.join(pt, F.col("l_partkey") == F.col("p_partkey"), "inner")
    k, p = F.col("l_orderkey"), F.col("l_partkey")
    return j.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(k % 20 == 7, F.lit("invalid-date"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        _null_when((k + p) % 33 == 5, p.cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("p_size").cast("double") * F.lit(2.5)
         + (F.col("l_linenumber") % 4).cast("double") * F.lit(0.5)).alias("price"),
        _null_when(k % 4 == 3, F.col("o_orderstatus")).alias("status"),
    )


def raw_orders_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample-edition orders: the types JSON inference gives (ids and quantity long)."""
    r = raw_orders(spark, sf_dir)
    return r.select(
        F.col("category"), F.col("customer_id").cast("long").alias("customer_id"),
        F.col("order_date"), F.col("order_id").cast("long").alias("order_id"),
        F.col("price"), F.col("product_id").cast("long").alias("product_id"),
        F.col("product_name"), F.col("quantity").cast("long").alias("quantity"), F.col("status"),
    )


def raw_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_activity_raw from ``events``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    e = F.col("event_id")
    return ev.select(
        F.col("user_id").cast("int").alias("customer_id"),
        F.when(e % 40 == 11, F.lit("invalid-timestamp")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(e % 60 == 17, F.lit(-1)).otherwise((F.lit(1) + e % 5).cast("int")).alias("page_views"),
        F.when(F.col("event_type").isin("click", "purchase"), (F.lit(1) + e % 2).cast("int"))
         .otherwise(F.lit(0)).alias("cart_adds"),
        F.when(F.col("event_type") == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("purchases"),
        F.when(e % 3 == 0, "desktop").when(e % 3 == 1, "mobile").otherwise("tablet").alias("device"),
        F.concat(F.lit("city_"), (e % 8).cast("string")).alias("location"),
        e.cast("string").alias("session_id"),
    )


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_profiles_raw from ``customer``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    return c.select(
        k.cast("int").alias("customer_id"),
        _null_when(k % 50 == 3,
                   F.date_sub(F.lit("2024-02-01").cast("date"), (k % 1095).cast("int")).cast("string")
                   ).alias("signup_date"),
        F.concat(F.lit("age_"), (F.col("c_nationkey") % 6).cast("string")).alias("age_group"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("Other").alias("gender"),
        F.when(bal < 2500, "25k-50k").when(bal < 5000, "50k-75k")
         .when(bal < 7500, "75k-100k").otherwise("100k+").alias("income_bracket"),
        F.col("c_mktsegment").alias("loyalty_tier"),
    )


def defective_orders(raw: DataFrame) -> DataFrame:
    """Raw orders with a defect for every predicate that the plain binding never fails."""
    k, c, q = F.col("order_id").cast("long"), F.col("customer_id").cast("long"), F.col("quantity")
    return raw.withColumns({
        "order_id": F.when(k % 101 == 3, F.lit(None)).when(k % 101 == 5, "  ").otherwise(F.col("order_id")),
        "customer_id": F.when(c % 97 == 1, F.lit(None)).when(c % 97 == 2, "").otherwise(F.col("customer_id")),
        "quantity": F.when(q % 11 == 2, 0).when(q % 11 == 3, 20000).otherwise(q),
        "price": F.when(k % 83 == 4, 0.0).when(k % 83 == 5, 200000.0).otherwise(F.col("price"))})


def defective_activity(raw: DataFrame) -> DataFrame:
    e = F.col("session_id").cast("long")
    return raw.withColumns({"customer_id": _null_when(e % 71 == 1, F.col("customer_id")),
                            "cart_adds": F.when(e % 73 == 2, -1).otherwise(F.col("cart_adds")),
                            "purchases": F.when(e % 79 == 3, -1).otherwise(F.col("purchases"))})


def defective_profiles(raw: DataFrame) -> DataFrame:
    return raw.withColumn("customer_id", _null_when(F.col("customer_id") % 61 == 7, F.col("customer_id")))


def as_bronze(df: DataFrame) -> DataFrame:
    """Audit columns for a bronze frame that does not come from a file reader."""
    return (df.withColumn("ingestion_timestamp", F.current_timestamp())
              .withColumn("source_file", F.lit(None).cast("string")))

