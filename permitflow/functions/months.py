"""Water-year month numbering (July = 1)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from ..config import MONTH_TO_WATER_MONTH, WATER_MONTH_TO_NAME


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def water_month(col: Column | str, default: str | None = None, strict: bool = True) -> Column:
    """Month name -> water-year number. ``default`` is the month used for
    unclassified text (folded into the lookup map, so the input is read once).

    With ``strict`` an unmapped non-null name fails the job (the reference raises
    when it converts such a value to int).
    """
    from ..config import UNCLASSIFIED
    c = F.col(col) if isinstance(col, str) else col
    mapping = dict(MONTH_TO_WATER_MONTH)
    if default is not None:
        mapping[UNCLASSIFIED] = MONTH_TO_WATER_MONTH[default]
    mapped = F.try_element_at(_map_literal(mapping), c)
    if strict:
        return F.coalesce(mapped, F.when(c.isNotNull(), F.raise_error(F.lit("unknown month name")).cast("int")))
    return mapped


def water_month_name(col: Column | str, default: str = "Jul") -> Column:
    """Water-year number -> month name; anything unmapped gives ``default``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_element_at(_map_literal(WATER_MONTH_TO_NAME), c.cast("int")), F.lit(default))
