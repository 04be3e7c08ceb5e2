"""Date helpers (X7). ``as_of`` dates are parameters, never ``current_date()``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_date_safe(col) -> Column:
    """Text -> date, unparsable -> null."""
    return _c(col).try_cast("date")


def to_timestamp_safe(col) -> Column:
    return _c(col).try_cast("timestamp_ntz")


def add_years(col, years: int) -> Column:
    """Calendar years; Feb 29 goes to Feb 28 in non-leap years."""
    return F.add_months(_c(col), 12 * years)


def add_days(col, days: int) -> Column:
    return F.date_add(_c(col), days)


def date_text(col, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_c(col), fmt)


def on_or_before(col, as_of: str) -> Column:
    return _c(col) <= F.lit(as_of).cast("date")
