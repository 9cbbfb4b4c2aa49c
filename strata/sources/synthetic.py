"""GEN-1..3: synthetic orders, profiles and activity as distributed Spark jobs.

Rows are derived from integer seeds (``spark.range`` or the keys of an
existing table), never built in driver memory. Every random draw is a pure
function of (seed, salt): an integer hash in 64-bit arithmetic, so the output
does not depend on partitioning or task order and an SQL engine can repeat it.
Fan-out (lines per order, sessions per day) is ``explode(sequence(...))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import today

P = 2147483647  # 2^31 - 1

# The generated catalogue.
PRODUCTS = [  # (product_id, name, category, price)
    (1, "Laptop", "Electronics", 1200.0),
    (2, "Smartphone", "Electronics", 800.0),
    (3, "Headphones", "Electronics", 150.0),
    (4, "T-shirt", "Clothing", 25.0),
    (5, "Jeans", "Clothing", 60.0),
    (6, "Sneakers", "Footwear", 120.0),
    (7, "Coffee Maker", "Home", 89.0),
    (8, "Blender", "Home", 49.0),
]
STATUSES = ["completed", "pending", "cancelled", None]
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
GENDERS = ["M", "F", "Other"]
INCOME_BRACKETS = ["25k-50k", "50k-75k", "75k-100k", "100k+"]
LOYALTY_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
DEVICES = ["desktop", "mobile", "tablet"]
LOCATIONS = ["New York", "San Francisco", "Chicago", "Austin", "Seattle", "Boston", "Denver", "Miami"]
STEPS = [1, 3, 5, 7]  # odd strides: j-th product of an order = (offset + j * step) mod 8, all distinct


def _mix(x: Column) -> Column:
    r = x % P
    return ((r * r) % P * 16807 + r * 48271 + 12345) % P


def hashed(seed: Column, salt: int) -> Column:
    """Uniform integer in [0, P) from a non-negative seed."""
    x0 = ((seed % P) * 65539 + salt * 7919 + 1) % P
    return _mix(_mix(x0))


def unit(seed: Column, salt: int) -> Column:
    """Uniform double in [0, 1)."""
    return hashed(seed, salt) / F.lit(float(P))


def pick(values, seed: Column, salt: int) -> Column:
    lits = [F.lit(v) if v is not None else F.lit(None).cast("string") for v in values]
    return F.element_at(F.array(*lits), (hashed(seed, salt) % len(values) + 1).cast("int"))


def _seeds(spark: SparkSession, seeds, column: str, spread: bool = False,
           partitions: int | None = None) -> DataFrame:
    """Seed ids as one long column. With ``spread`` the (small) id column is
    hash-distributed over an explicit number of partitions before a fan-out,
    so the generated rows do not stay in the seed table's few input tasks
    (an explicit count is kept by AQE instead of being coalesced away)."""
    if isinstance(seeds, int):
        df = spark.range(1, seeds + 1).select(F.col("id").alias(column))
    else:
        df = seeds.select(F.col(seeds.columns[0]).cast("long").alias(column))
    if spread:
        n = partitions or max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions")))
        df = df.repartition(n, column)
    return df


def generate_orders(spark: SparkSession, seeds=1000, as_of=None, num_customers: int = 100,
                    days_back: int = 30, partitions: int | None = None) -> DataFrame:
    """GEN-1: 1-3 distinct products per order; 5% of orders carry 'invalid-date',
    3% of lines a missing product_id, a quarter of orders a NULL status."""
    o = F.col("order_id")
    base = _seeds(spark, seeds, "order_id", True, partitions).select(
        o, (F.lit(1) + hashed(o, 1) % num_customers).alias("customer_id"),
        F.when(hashed(o, 4) % 100 < 5, F.lit("invalid-date"))
         .otherwise(F.date_format(F.date_sub(today(as_of), (hashed(o, 2) % (days_back + 1)).cast("int")),
                                  "yyyy-MM-dd")).alias("order_date"),
        pick(STATUSES, o, 3).alias("status"),
        (hashed(o, 6) % 8).alias("_offset"),
        F.element_at(F.array(*[F.lit(s) for s in STEPS]), (hashed(o, 7) % 4 + 1).cast("int")).alias("_step"),
        F.explode(F.sequence(F.lit(0), (hashed(o, 5) % 3).cast("int"))).alias("_j"))
    line = o * 4 + F.col("_j")
    idx = ((F.col("_offset") + F.col("_j") * F.col("_step")) % 8 + 1).cast("int")
    col_of = lambda k: F.element_at(F.array(*[F.lit(p[k]) for p in PRODUCTS]), idx)
    return base.select(
        o, "customer_id", "order_date", "status",
        F.when(hashed(line, 9) % 100 < 3, F.lit(None).cast("long")).otherwise(col_of(0).cast("long"))
         .alias("product_id"),
        col_of(1).alias("product_name"), col_of(2).alias("category"), col_of(3).alias("price"),
        (F.lit(1) + hashed(line, 8) % 5).alias("quantity"))


def generate_customer_profiles(spark: SparkSession, seeds=100, as_of=None) -> DataFrame:
    """GEN-2: signup 180-1095 days before the run date and four categorical attributes."""
    c = F.col("customer_id")
    return _seeds(spark, seeds, "customer_id").select(
        c, F.date_format(F.date_sub(today(as_of), (F.lit(180) + hashed(c, 11) % 916).cast("int")),
                         "yyyy-MM-dd").alias("signup_date"),
        pick(AGE_GROUPS, c, 12).alias("age_group"), pick(GENDERS, c, 13).alias("gender"),
        pick(INCOME_BRACKETS, c, 14).alias("income_bracket"), pick(LOYALTY_TIERS, c, 15).alias("loyalty_tier"))


def generate_customer_activity(spark: SparkSession, seeds=100, as_of=None, days_back: int = 30,
                               sessions_per_day: int = 5, partitions: int | None = None) -> DataFrame:
    """GEN-3: per customer and day, 70% active, 1..sessions_per_day sessions at
    08:00-23:59; page views ~ exponential(0.2) clamped to 1..50; 30% add to cart,
    40% of those buy; 5% of rows carry one defect (NULL customer — that row
    only —, 'invalid-timestamp', or page_views = -1).

    Keys of the draws count days and sessions in strides of 1024 and 16, or of
    ``days_back`` and ``sessions_per_day`` where those are more, so they never meet."""
    per_customer, per_day = max(1024, days_back), max(16, sessions_per_day)
    c, d, s = F.col("customer_id"), F.col("_d"), F.col("_s")
    days = (_seeds(spark, seeds, "customer_id", True, partitions)
            .select(c, F.explode(F.sequence(F.lit(0), F.lit(days_back - 1))).alias("_d")))
    cd = c * per_customer + d
    # Per-day values are computed before the sessions fan out.
    active = days.filter(hashed(cd, 21) % 100 < 70).select(
        c, d, F.date_format(F.date_sub(today(as_of), d), "yyyy-MM-dd").alias("_day"),
        F.explode(F.sequence(F.lit(0), (hashed(cd, 22) % sessions_per_day).cast("int"))).alias("_s"))
    key = cd * per_day + s
    # Every draw once per row, as a column (the optimizer does not duplicate them).
    k = F.col("_k")
    draws = active.select(c, F.col("_day"), key.alias("_k")).select(
        c, F.col("_day"), k, *[hashed(k, salt).alias(f"_h{salt}") for salt in range(23, 34)])
    h = {salt: F.col(f"_h{salt}") for salt in range(23, 34)}
    pv_col = F.least(F.lit(50), F.greatest(F.lit(1), F.floor(-F.log(F.lit(1.0) - h[27] / F.lit(float(P))) / 0.2)))
    with_pv = draws.withColumn("_pv", pv_col.cast("int"))
    pv = F.col("_pv")
    cart = F.when(h[28] % 100 < 30,
                  F.lit(1) + h[29] % F.greatest(F.lit(1), F.least(F.lit(5), F.floor(pv / 2)))
                  ).otherwise(F.lit(0)).cast("int")
    with_cart = with_pv.withColumn("_cart", cart)
    ca = F.col("_cart")
    ts = F.concat(F.col("_day"), F.lit("T"), F.lpad((F.lit(8) + h[23] % 16).cast("string"), 2, "0"), F.lit(":"),
                  F.lpad((h[24] % 60).cast("string"), 2, "0"), F.lit(":00"))
    hexd = F.sha2(k.cast("string"), 256)
    sid = F.concat_ws("-", *[F.substring(hexd, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    buys = F.when((ca > 0) & (h[30] % 100 < 40), F.lit(1) + h[31] % ca).otherwise(F.lit(0))
    defect = F.when(h[32] % 100 < 5, h[33] % 3)
    return with_cart.select(
        F.when(defect == 0, F.lit(None).cast("long")).otherwise(c).cast("int").alias("customer_id"),
        F.when(defect == 1, F.lit("invalid-timestamp")).otherwise(ts).alias("timestamp"),
        F.when(defect == 2, F.lit(-1)).otherwise(pv).alias("page_views"),
        ca.alias("cart_adds"), buys.cast("int").alias("purchases"),
        F.element_at(F.array(*[F.lit(v) for v in DEVICES]), (h[25] % len(DEVICES) + 1).cast("int")).alias("device"),
        F.element_at(F.array(*[F.lit(v) for v in LOCATIONS]), (h[26] % len(LOCATIONS) + 1).cast("int"))
         .alias("location"),
        sid.alias("session_id"))
