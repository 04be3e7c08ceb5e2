"""Column functions (X1-X10): pure ``Column -> Column`` builders, all JVM-side."""

from .months import water_month, water_month_name
from .measures import (
    volume_to_rate, rate_to_volume, half_even, finite_or_zero, share,
    available, percent, months_span,
)
from .text import strip_ws, title_words, fix_spacing, replace_word, contains_text
from .dates import add_years, add_days, date_text, to_date_safe, to_timestamp_safe, on_or_before
from .json import json_field

__all__ = [
    "water_month", "water_month_name", "volume_to_rate", "rate_to_volume", "half_even",
    "finite_or_zero", "share", "available", "percent", "months_span", "strip_ws", "title_words",
    "fix_spacing", "replace_word", "contains_text", "add_years", "add_days", "date_text",
    "to_date_safe", "to_timestamp_safe", "on_or_before", "json_field",
]
