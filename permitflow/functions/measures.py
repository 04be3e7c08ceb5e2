"""Rates, volumes, rounding and shares."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..config import DAYS_PER_MONTH, SECONDS_PER_DAY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def months_span(from_month, to_month) -> Column:
    return _c(to_month) - _c(from_month) + F.lit(1)


def volume_to_rate(volume, days=None, months=None) -> Column:
    """Volume (m3) over a period -> rate in l/s.

    ``days`` gives ``volume / days / 24 / 60 / 60 * 1000``; ``months`` uses
    30.42 days a month. Operand order follows the reference so results agree to
    the last bit.
    """
    v = _c(volume)
    if months is not None:
        return v / 60 / 60 / 24 / F.lit(DAYS_PER_MONTH) / _c(months) * 1000
    if days is None:
        raise ValueError("days or months required")
    if isinstance(days, (int, float)) and days == 1:
        return (v / 24 / 60 / 60) * 1000
    d = F.lit(days) if isinstance(days, (int, float)) else _c(days)
    return (v / d / 24 / 60 / 60) * 1000


def rate_to_volume(rate, months=None, days=None) -> Column:
    """Rate (l/s) -> volume (m3) over ``months`` (30.42 d each) or ``days``."""
    r = _c(rate)
    if months is not None:
        return r * 0.001 * 60 * 60 * 24 * F.lit(DAYS_PER_MONTH) * _c(months)
    return r * F.lit(SECONDS_PER_DAY) * 0.001 * (_c(days) if not isinstance(days, (int, float)) else F.lit(days))


def half_even(col, digits: int = 0) -> Column:
    """pandas/numpy ``round``: half to even."""
    return F.bround(_c(col), digits)


def finite_or_zero(col) -> Column:
    """null, NaN or +-inf -> 0."""
    c = _c(col)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(0.0)).otherwise(c)


def share(part, total, default: float) -> Column:
    """part / total, with ``default`` when undefined (total 0 or null)."""
    return F.coalesce(F.try_divide(_c(part), _c(total)), F.lit(default))


def available(limit, used) -> Column:
    """Limit minus use; 0 when there is no limit (limit = 0)."""
    lim = _c(limit)
    return F.when(lim == 0, F.lit(0)).otherwise(lim - _c(used))


def percent(limit, used) -> Column:
    """Used as a percentage of the limit, rounded to int (0 when limit = 0)."""
    lim = _c(limit)
    return F.when(lim == 0, F.lit(0)).otherwise(
        F.round(_c(used).cast("double") / lim * 100).cast("int"))
