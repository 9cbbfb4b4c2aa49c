"""FN-1..9: date parsing and calendar expressions that are safe under ANSI.

``as_of`` fixes the run date; None means ``current_date()``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def today(as_of: _dt.date | str | None = None) -> Column:
    """FN-9: the run date as a column."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """FN-1: string -> DATE, NULL when unparsable (``try_to_date``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c, fmt)


def parse_timestamp(col) -> Column:
    """String -> TIMESTAMP, NULL when unparsable."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def date_of(col) -> Column:
    """FN-2: ISO string -> DATE."""
    return F.to_date(parse_timestamp(col))


def hour_of(col) -> Column:
    """FN-3: hour of an ISO timestamp string."""
    return F.hour(parse_timestamp(col))


def is_weekend(date_col) -> Column:
    """FN-6: Sunday (1) or Saturday (7)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.dayofweek(c).isin(1, 7)


def days_since(date_col, as_of=None) -> Column:
    """FN-7 against the run date."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.datediff(today(as_of), c)


def days_before(n: int, as_of=None) -> Column:
    """FN-8: run date minus n days (folded to a literal by the optimizer)."""
    return F.date_sub(today(as_of), n)
