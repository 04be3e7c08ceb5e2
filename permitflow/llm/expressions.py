"""Small helpers for DataFrame expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once for a row.

    A projected column that is used inside a lambda may be inlined by the optimizer and then evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
