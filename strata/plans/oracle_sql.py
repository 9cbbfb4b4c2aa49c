"""Independent DuckDB SQL for every registered query (the correctness oracle).

Conventions that make the two engines agree value for value:
- ``sround(x, n)`` reproduces Spark's ``round`` on a double (half-up on the
  shortest decimal rendering) via VARCHAR -> DECIMAL.
- Integer sums are cast to BIGINT and calendar parts to INTEGER (Spark types).
- Audit timestamps and file lineage are not part of any compared output.
- Sample standard deviations are compared at 6 decimals on both sides.
"""

from __future__ import annotations

# The raw-input bindings as SQL (FIXTURES.md §4; the Spark side is strata/sources/bindings.py).
ORACLE_RAW_ORDERS = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE WHEN l_orderkey % 20 = 7 THEN 'invalid-date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
  CASE WHEN (l_orderkey + l_partkey) % 33 = 5 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
  p_name AS product_name, p_type AS category, CAST(l_quantity AS INTEGER) AS quantity,
  CAST(p_size AS DOUBLE) * CAST(2.5 AS DOUBLE) + CAST(l_linenumber % 4 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS price,
  CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE o_orderstatus END AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

ORACLE_RAW_ACTIVITY = """
SELECT CAST(user_id AS INTEGER) AS customer_id,
  CASE WHEN event_id % 40 = 11 THEN 'invalid-timestamp' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
  CASE WHEN event_id % 60 = 17 THEN -1 ELSE CAST(1 + event_id % 5 AS INTEGER) END AS page_views,
  CASE WHEN event_type IN ('click', 'purchase') THEN CAST(1 + event_id % 2 AS INTEGER) ELSE 0 END AS cart_adds,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS purchases,
  CASE event_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
  concat('city_', CAST(event_id % 8 AS VARCHAR)) AS location, CAST(event_id AS VARCHAR) AS session_id
FROM events
"""

ORACLE_RAW_PROFILES = """
SELECT CAST(c_custkey AS INTEGER) AS customer_id,
  CASE WHEN c_custkey % 50 = 3 THEN NULL
       ELSE CAST(DATE '2024-02-01' - CAST(c_custkey % 1095 AS INTEGER) AS VARCHAR) END AS signup_date,
  concat('age_', CAST(c_nationkey % 6 AS VARCHAR)) AS age_group,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
  CASE WHEN c_acctbal < 2500 THEN '25k-50k' WHEN c_acctbal < 5000 THEN '50k-75k'
       WHEN c_acctbal < 7500 THEN '75k-100k' ELSE '100k+' END AS income_bracket,
  c_mktsegment AS loyalty_tier
FROM customer
"""


def sround(expr: str, places: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def silver_orders_cte(max_quantity: int, max_price: float) -> str:
    return f"""
raw_orders AS ({ORACLE_RAW_ORDERS}),
clean_orders AS (
  SELECT order_id, customer_id, CAST(TRY_STRPTIME(order_date, '%Y-%m-%d') AS DATE) AS order_date,
    product_id, coalesce(product_name, 'unknown') AS product_name,
    coalesce(category, 'uncategorized') AS category, quantity, price,
    coalesce(status, 'unknown') AS status, {sround('price * quantity', 2)} AS total_item_price
  FROM raw_orders),
ranked_orders AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY
    quantity NULLS FIRST, price NULLS FIRST, status NULLS FIRST, customer_id NULLS FIRST,
    order_date NULLS FIRST, product_name NULLS FIRST, category NULLS FIRST) AS rn
  FROM clean_orders),
silver_orders AS (
  SELECT order_id, customer_id, order_date, product_id, product_name, category, quantity, price,
    status, total_item_price,
    CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    CAST(dayofweek(order_date) + 1 AS INTEGER) AS order_day_of_week,
    CASE WHEN price <= 10.0 THEN 'Low' WHEN price <= 100.0 THEN 'Medium' ELSE 'High' END AS price_tier
  FROM ranked_orders
  WHERE rn = 1
    AND order_id IS NOT NULL AND length(trim(order_id)) > 0
    AND customer_id IS NOT NULL AND length(trim(customer_id)) > 0
    AND product_id IS NOT NULL AND length(trim(product_id)) > 0
    AND order_date IS NOT NULL AND length(CAST(order_date AS VARCHAR)) = 10
    AND quantity > 0 AND quantity <= {max_quantity}
    AND price > 0 AND price <= {max_price}
    AND regexp_matches(CAST(order_date AS VARCHAR), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'))
"""


def silver_activity_cte() -> str:
    return f"""
raw_activity AS ({ORACLE_RAW_ACTIVITY}),
clean_activity AS (
  SELECT *, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS activity_date,
    CAST(hour(TRY_CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS activity_hour,
    page_views * 1 + cart_adds * 5 + purchases * 10 AS engagement_score
  FROM raw_activity),
ranked_activity AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id, session_id ORDER BY
    "timestamp" NULLS FIRST, page_views NULLS FIRST, cart_adds NULLS FIRST, purchases NULLS FIRST,
    device NULLS FIRST, location NULLS FIRST) AS rn
  FROM clean_activity),
silver_activity AS (
  SELECT customer_id, "timestamp", page_views, cart_adds, purchases, device, location, session_id,
    activity_date, activity_hour, dayofweek(activity_date) IN (0, 6) AS is_weekend,
    engagement_score, CAST(year(activity_date) AS INTEGER) AS activity_year,
    CAST(month(activity_date) AS INTEGER) AS activity_month
  FROM ranked_activity
  WHERE rn = 1 AND customer_id IS NOT NULL
    AND "timestamp" IS NOT NULL AND "timestamp" != 'invalid-timestamp'
    AND page_views >= 0 AND cart_adds >= 0 AND purchases >= 0)
"""


def silver_profile_cte(as_of: str) -> str:
    return f"""
raw_profiles AS ({ORACLE_RAW_PROFILES}),
silver_profile AS (
  SELECT *, CAST(DATE '{as_of}' - signup_date_parsed AS INTEGER) AS days_since_signup
  FROM (SELECT *, CAST(TRY_STRPTIME(signup_date, '%Y-%m-%d') AS DATE) AS signup_date_parsed
        FROM raw_profiles)
  WHERE customer_id IS NOT NULL AND signup_date IS NOT NULL),
silver_profile_seg AS (
  SELECT *, CASE WHEN days_since_signup <= 90 THEN 'New' WHEN days_since_signup <= 365 THEN 'Growing'
    WHEN days_since_signup <= 730 THEN 'Established' ELSE 'Veteran' END AS customer_vintage_segment
  FROM silver_profile)
"""


def engagement_cte(as_of: str) -> str:
    return f"""
engagement_agg AS (
  SELECT customer_id,
    CAST(sum(page_views) AS BIGINT) AS total_page_views, CAST(sum(cart_adds) AS BIGINT) AS total_cart_adds,
    CAST(sum(purchases) AS BIGINT) AS total_purchases, avg(engagement_score) AS avg_engagement_score,
    max(engagement_score) AS max_engagement_score,
    {sround('stddev_samp(engagement_score)', 6)} AS engagement_score_stddev,
    max(activity_date) AS last_activity_date, min(activity_date) AS first_activity_date,
    count(DISTINCT activity_date) AS active_days, count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT CASE WHEN is_weekend THEN activity_date END) AS weekend_activity_days,
    avg(activity_hour) AS avg_activity_hour
  FROM silver_activity GROUP BY customer_id),
engagement AS (
  SELECT *,
    {sround('CAST(total_page_views AS DOUBLE) / NULLIF(total_sessions, 0)', 2)} AS avg_page_views_per_session,
    CASE WHEN total_cart_adds > 0 THEN {sround('CAST(total_purchases AS DOUBLE) / total_cart_adds', 3)}
         ELSE 0.0 END AS conversion_rate_cart_to_purchase,
    CAST(DATE '{as_of}' - last_activity_date AS INTEGER) AS days_since_last_activity,
    {sround('CAST(active_days AS DOUBLE) / NULLIF(CAST(last_activity_date - first_activity_date AS DOUBLE), 0) * 100', 2)}
      AS activity_consistency_score
  FROM engagement_agg)
"""


BEHAVIOR_CTE = f"""
device_counts AS (
  SELECT customer_id,
    count(*) FILTER (WHERE device = 'desktop') AS desktop_sessions,
    count(*) FILTER (WHERE device = 'mobile') AS mobile_sessions,
    count(*) FILTER (WHERE device = 'tablet') AS tablet_sessions,
    count(DISTINCT location) AS unique_locations
  FROM silver_activity GROUP BY customer_id),
behavior AS (
  SELECT customer_id, desktop_sessions, mobile_sessions, tablet_sessions, unique_locations,
    desktop_sessions + mobile_sessions + tablet_sessions AS device_total_sessions,
    CASE WHEN desktop_sessions + mobile_sessions + tablet_sessions > 0
         THEN {sround('CAST(mobile_sessions AS DOUBLE) / (desktop_sessions + mobile_sessions + tablet_sessions)', 3)}
         ELSE 0.0 END AS mobile_preference_score,
    CASE WHEN desktop_sessions + mobile_sessions + tablet_sessions > 0
         THEN {sround('CAST(desktop_sessions AS DOUBLE) / (desktop_sessions + mobile_sessions + tablet_sessions)', 3)}
         ELSE 0.0 END AS desktop_preference_score,
    (CAST(desktop_sessions > 0 AS INTEGER) + CAST(mobile_sessions > 0 AS INTEGER)
      + CAST(tablet_sessions > 0 AS INTEGER)) >= 2 AS multi_device_user
  FROM device_counts)
"""


# ---------------------------------------------------------------- generators (same integer hash)

_P = 2147483647


def _mix_sql(x: str) -> str:
    r = f"(({x}) % {_P})"
    return f"(({r} * {r}) % {_P} * 16807 + {r} * 48271 + 12345) % {_P}"


def hashed_sql(seed: str, salt: int) -> str:
    x0 = f"((({seed}) % {_P}) * 65539 + {salt * 7919 + 1}) % {_P}"
    return f"({_mix_sql(_mix_sql(x0))})"


def _list(values, cast: str = "") -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS {cast})" if cast else repr(v)
    return "[" + ", ".join(lit(v) for v in values) + "]"


def gen_orders_sql(seed_sql: str, as_of: str, num_customers: int = 100, days_back: int = 30) -> str:
    from strata.sources.synthetic import PRODUCTS, STATUSES, STEPS
    h = hashed_sql
    o = "order_id"
    line = "(order_id * 4 + _j)"
    return f"""WITH s AS ({seed_sql}),
b AS (SELECT {o}, 1 + {h(o, 1)} % {num_customers} AS customer_id,
  CASE WHEN {h(o, 4)} % 100 < 5 THEN 'invalid-date'
       ELSE strftime(DATE '{as_of}' - CAST({h(o, 2)} % {days_back + 1} AS INTEGER), '%Y-%m-%d') END AS order_date,
  {_list(STATUSES)}[{h(o, 3)} % 4 + 1] AS status,
  {h(o, 6)} % 8 AS _offset, {_list(STEPS)}[{h(o, 7)} % 4 + 1] AS _step,
  unnest(generate_series(0, {h(o, 5)} % 3)) AS _j
  FROM s),
l AS (SELECT *, CAST((_offset + _j * _step) % 8 + 1 AS INTEGER) AS idx FROM b)
SELECT order_id, customer_id, order_date, status,
  CASE WHEN {h(line, 9)} % 100 < 3 THEN NULL ELSE CAST({_list([p[0] for p in PRODUCTS])}[idx] AS BIGINT) END
    AS product_id,
  {_list([p[1] for p in PRODUCTS])}[idx] AS product_name, {_list([p[2] for p in PRODUCTS])}[idx] AS category,
  {_list([p[3] for p in PRODUCTS], 'DOUBLE')}[idx] AS price,
  1 + {h(line, 8)} % 5 AS quantity
FROM l"""


def gen_profiles_sql(seed_sql: str, as_of: str) -> str:
    from strata.sources.synthetic import AGE_GROUPS, GENDERS, INCOME_BRACKETS, LOYALTY_TIERS
    h = hashed_sql
    c = "customer_id"
    return f"""WITH s AS ({seed_sql})
SELECT {c}, strftime(DATE '{as_of}' - CAST(180 + {h(c, 11)} % 916 AS INTEGER), '%Y-%m-%d') AS signup_date,
  {_list(AGE_GROUPS)}[{h(c, 12)} % 6 + 1] AS age_group, {_list(GENDERS)}[{h(c, 13)} % 3 + 1] AS gender,
  {_list(INCOME_BRACKETS)}[{h(c, 14)} % 4 + 1] AS income_bracket,
  {_list(LOYALTY_TIERS)}[{h(c, 15)} % 4 + 1] AS loyalty_tier
FROM s"""


def gen_activity_sql(seed_sql: str, as_of: str, days_back: int = 30, sessions_per_day: int = 5) -> str:
    from strata.sources.synthetic import DEVICES, LOCATIONS
    h = hashed_sql
    cd = f"(customer_id * {max(1024, days_back)} + _d)"
    k = "_k"
    u = f"(CAST({h(k, 27)} AS DOUBLE) / CAST({_P} AS DOUBLE))"
    pv = f"CAST(least(50, greatest(1, floor(-ln(CAST(1.0 AS DOUBLE) - {u}) / CAST(0.2 AS DOUBLE)))) AS INTEGER)"
    return f"""WITH s AS ({seed_sql}),
days AS (SELECT customer_id, unnest(generate_series(0, {days_back - 1})) AS _d FROM s),
sess AS (SELECT customer_id, _d, unnest(generate_series(0, {h(cd, 22)} % {sessions_per_day})) AS _s
  FROM days WHERE {h(cd, 21)} % 100 < 70),
r1 AS (SELECT customer_id, _d, ({cd}) * {max(16, sessions_per_day)} + _s AS _k FROM sess),
r2 AS (SELECT *, {pv} AS pv,
  concat(strftime(DATE '{as_of}' - CAST(_d AS INTEGER), '%Y-%m-%d'), 'T',
    lpad(CAST(8 + {h(k, 23)} % 16 AS VARCHAR), 2, '0'), ':', lpad(CAST({h(k, 24)} % 60 AS VARCHAR), 2, '0'),
    ':00') AS ts,
  {_list(DEVICES)}[{h(k, 25)} % 3 + 1] AS device, {_list(LOCATIONS)}[{h(k, 26)} % 8 + 1] AS location,
  sha256(CAST(_k AS VARCHAR)) AS hx,
  CASE WHEN {h(k, 32)} % 100 < 5 THEN {h(k, 33)} % 3 END AS defect
  FROM r1),
r3 AS (SELECT *, CAST(CASE WHEN {h(k, 28)} % 100 < 30
    THEN 1 + {h(k, 29)} % greatest(1, least(5, CAST(floor(pv / 2) AS BIGINT))) ELSE 0 END AS INTEGER) AS cart_adds
  FROM r2)
SELECT CAST(CASE WHEN defect = 0 THEN NULL ELSE customer_id END AS INTEGER) AS customer_id,
  CASE WHEN defect = 1 THEN 'invalid-timestamp' ELSE ts END AS "timestamp",
  CASE WHEN defect = 2 THEN -1 ELSE pv END AS page_views, cart_adds,
  CAST(CASE WHEN cart_adds > 0 AND {h(k, 30)} % 100 < 40 THEN 1 + {h(k, 31)} % cart_adds ELSE 0 END AS INTEGER)
    AS purchases,
  device, location,
  concat_ws('-', substring(hx, 1, 8), substring(hx, 9, 4), substring(hx, 13, 4), substring(hx, 17, 4),
    substring(hx, 21, 12)) AS session_id
FROM r3"""
