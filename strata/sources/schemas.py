"""SRC-6: schemas of the three raw inputs, built from (name, type, nullable) specs."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"STRING": T.StringType, "INT": T.IntegerType, "DOUBLE": T.DoubleType}


def build_schema(spec=None) -> T.StructType:
    """Spec rows are (name, type, nullable); only STRING, INT and DOUBLE are accepted.
    Without a spec, the raw orders schema."""
    if spec is None:
        spec = ORDERS_SPEC
    fields = []
    for name, type_name, nullable in spec:
        factory = _TYPES.get(str(type_name).upper())
        if factory is None:
            raise ValueError(f"Unsupported column type: {type_name}")
        fields.append(T.StructField(name, factory(), bool(nullable)))
    return T.StructType(fields)


# Raw input column specs (name, type, nullable).
ORDERS_SPEC = [
    ("order_id", "STRING", False),
    ("customer_id", "STRING", False),
    ("order_date", "STRING", True),
    ("product_id", "STRING", False),
    ("product_name", "STRING", True),
    ("category", "STRING", True),
    ("quantity", "INT", True),
    ("price", "DOUBLE", True),
    ("status", "STRING", True),
]
ACTIVITY_SPEC = [
    ("customer_id", "INT", True),
    ("timestamp", "STRING", True),
    ("page_views", "INT", True),
    ("cart_adds", "INT", True),
    ("purchases", "INT", True),
    ("device", "STRING", True),
    ("location", "STRING", True),
    ("session_id", "STRING", True),
]
PROFILE_SPEC = [
    ("customer_id", "INT", False),
    ("signup_date", "STRING", True),
    ("age_group", "STRING", True),
    ("gender", "STRING", True),
    ("income_bracket", "STRING", True),
    ("loyalty_tier", "STRING", True),
]

ORDERS_SCHEMA = build_schema(ORDERS_SPEC)
ACTIVITY_SCHEMA = build_schema(ACTIVITY_SPEC)
PROFILE_SCHEMA = build_schema(PROFILE_SPEC)

ORDERS_COLUMNS = [n for n, _, _ in ORDERS_SPEC]
ACTIVITY_COLUMNS = [n for n, _, _ in ACTIVITY_SPEC]
PROFILE_COLUMNS = [n for n, _, _ in PROFILE_SPEC]
