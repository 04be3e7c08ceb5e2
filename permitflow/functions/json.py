"""JSON field access."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_field(col, path: str, cast: str | None = None) -> Column:
    """Field of loose JSON text by ``$.a.b`` path; optional type cast (bad -> null)."""
    c = F.col(col) if isinstance(col, str) else col
    v = F.get_json_object(c, path)
    if cast:
        return v.try_cast(cast)
    return v
