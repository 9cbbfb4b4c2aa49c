"""SEG-1..21: derived business columns as built-in expressions.

NULL inputs fall through to the ``otherwise`` branch of every chain; bounds are
inclusive as written. Thresholds come from ``PipelineConfig`` where the
pipeline configures them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.config import PipelineConfig

# Bounds, weights and labels of the derived columns that are not
# configurable (configurable ones live in PipelineConfig).
STABILITY_BOUNDS = (0.1, 0.3)                # Low Variance, Medium Variance
POPULARITY_WEIGHTS = (0.4, 0.6, 100)         # customers, units, divisor
ENGAGEMENT_WEIGHTS = (1, 5, 10)              # page views, cart adds, purchases
VINTAGE_DAYS = (90, 365, 730)                # New, Growing, Established (else Veteran)
CHURN_HIGH = (30, 3)                         # days since activity >, avg engagement <
CHURN_MEDIUM = (14, 8)
PURCHASE_VALUE_BOUNDS = (20, 10, 3)          # high_value, medium_value, low_value
ENGAGEMENT_LEVEL_BOUNDS = (20, 10, 5)        # highly, moderately, lightly engaged


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """FN-12 division that yields NULL (not an ANSI error) on a zero divisor."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def price_tier(cfg: PipelineConfig, price="price") -> Column:  # SEG-1
    p = _c(price)
    return (F.when(p <= cfg.low_price_threshold, "Low")
             .when(p <= cfg.medium_price_threshold, "Medium").otherwise("High"))


def customer_segment(cfg: PipelineConfig, ltv="lifetime_value") -> Column:  # SEG-2
    v = _c(ltv)
    return (F.when(v >= cfg.premium_customer_threshold, "Premium")
             .when(v >= cfg.standard_customer_threshold, "Standard").otherwise("Basic"))


def frequency_segment(cfg: PipelineConfig, orders="total_orders") -> Column:  # SEG-3
    n = _c(orders)
    return (F.when(n >= cfg.frequent_customer_orders, "Frequent")
             .when(n >= cfg.regular_customer_orders, "Regular")
             .when(n >= cfg.occasional_customer_orders, "Occasional").otherwise("One-time"))


def value_segment(cfg: PipelineConfig, ltv="lifetime_value") -> Column:  # SEG-4
    v = _c(ltv)
    return (F.when(v >= cfg.premium_customer_threshold, "High Value")
             .when(v >= cfg.standard_customer_threshold, "Medium Value").otherwise("Low Value"))


def recency_segment(cfg: PipelineConfig, days="days_since_last_order") -> Column:  # SEG-5
    d = _c(days)
    return (F.when(d <= cfg.recent_days_threshold, "Recent")
             .when(d <= cfg.moderately_recent_days_threshold, "Moderately Recent")
             .when(d <= cfg.at_risk_days_threshold, "At Risk").otherwise("Dormant"))


def price_stability(lo="min_price", hi="max_price", avg="avg_price") -> Column:  # SEG-6
    spread = ratio(_c(hi) - _c(lo), avg)
    low, medium = STABILITY_BOUNDS
    return (F.when(_c(lo) == _c(hi), "Stable")
             .when(spread <= low, "Low Variance")
             .when(spread <= medium, "Medium Variance").otherwise("High Variance"))


def popularity_score(customers="unique_customers", units="total_units_sold") -> Column:  # SEG-7
    wc, wu, div = POPULARITY_WEIGHTS
    return F.round((_c(customers) * wc + _c(units) * wu) / div, 2)


def engagement_score(views="page_views", carts="cart_adds", buys="purchases") -> Column:  # SEG-8
    wv, wc, wb = ENGAGEMENT_WEIGHTS
    return _c(views) * wv + _c(carts) * wc + _c(buys) * wb


def vintage_segment(days="days_since_signup") -> Column:  # SEG-9
    d = _c(days)
    new, growing, established = VINTAGE_DAYS
    return (F.when(d <= new, "New").when(d <= growing, "Growing")
             .when(d <= established, "Established").otherwise("Veteran"))


def guarded_rate(num, den, places: int = 3) -> Column:  # SEG-10, SEG-13
    """den > 0 -> round(num/den, places), else 0.0."""
    return F.when(_c(den) > 0, F.round(ratio(num, den), places)).otherwise(F.lit(0.0))


def consistency_score(active="active_days", last="last_activity_date",
                      first="first_activity_date") -> Column:  # SEG-11
    """round(active_days / span_days * 100, 2); NULL when all activity is on one day."""
    return F.round(ratio(active, F.datediff(_c(last), _c(first))) * 100, 2)


def churn_risk(days="days_since_last_activity", avg="avg_engagement_score") -> Column:  # SEG-15
    d, a = _c(days), _c(avg)
    return (F.when((d > CHURN_HIGH[0]) | (a < CHURN_HIGH[1]), "high")
             .when((d > CHURN_MEDIUM[0]) | (a < CHURN_MEDIUM[1]), "medium").otherwise("low"))


def purchase_value_segment(purchases="total_purchases") -> Column:  # SEG-16
    p = _c(purchases)
    high, medium, low = PURCHASE_VALUE_BOUNDS
    return (F.when(p >= high, "high_value").when(p >= medium, "medium_value")
             .when(p >= low, "low_value").otherwise("minimal_value"))


def engagement_level(avg="avg_engagement_score") -> Column:  # SEG-17
    a = _c(avg)
    high, moderate, light = ENGAGEMENT_LEVEL_BOUNDS
    return (F.when(a >= high, "highly_engaged").when(a >= moderate, "moderately_engaged")
             .when(a >= light, "lightly_engaged").otherwise("disengaged"))


def avg_days_between(tenure="customer_tenure_days", orders="total_orders") -> Column:  # SEG-18
    return F.when(_c(orders) > 1, _c(tenure) / (_c(orders) - 1)).otherwise(F.lit(None).cast("double"))


def per_unit(total, count, places: int = 2) -> Column:  # SEG-19, SEG-21
    return F.round(ratio(total, count), places)
