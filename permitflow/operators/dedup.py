"""Keep-first-per-key operators.

``first_by`` is written as a grouped ``min``/``max`` over a struct of the sort
keys followed by the whole row. That aggregation is partial (map-side), so a
key holding a third of all rows is reduced on every executor before the
shuffle instead of being sorted inside one task, and the struct tail makes the
choice total and deterministic (ties broken by the remaining columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    BooleanType, DateType, NumericType, TimestampNTZType, TimestampType,
)

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc")


def _flip(df: DataFrame, name: str) -> Column | None:
    """An expression whose ascending order is ``name``'s descending order."""
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, BooleanType):
        return ~c
    if isinstance(t, NumericType):
        return -c
    if isinstance(t, DateType):
        return -F.datediff(c, F.lit("1970-01-01").cast("date"))
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    return None


def first_by(df: DataFrame, keys: Sequence[str], order: Order, nulls_last: bool = True) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (nulls last).

    Falls back to a ``row_number`` window only when a string column must be
    sorted against the dominant direction.
    """
    keys = list(keys)
    order = [(c, d.lower()) for c, d in order]
    desc_count = sum(1 for _, d in order if d == "desc")
    use_max = desc_count > len(order) - desc_count
    fields: list[Column] = []
    for i, (c, d) in enumerate(order):
        want_desc = d == "desc"
        if want_desc == use_max:
            expr = F.col(c)
        else:
            expr = _flip(df, c)
            if expr is None:
                return _first_by_window(df, keys, order)
        # nulls last: under min a leading isNull flag (false first); under max isNotNull
        flag = F.col(c).isNotNull() if use_max else F.col(c).isNull()
        if nulls_last:
            fields.append(flag.alias(f"_n{i}"))
        fields.append(expr.alias(f"_o{i}"))
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(*fields, F.struct(*[F.col(c) for c in payload]).alias("_row"))
    agg = (F.max if use_max else F.min)(packed).alias("_w")
    out = df.groupBy(*keys).agg(agg)
    return out.select(*keys, *[F.col("_w._row")[c].alias(c) for c in payload]).select(*df.columns)


def _first_by_window(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    cols = []
    for c, d in order:
        cols.append(F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last())
    # remaining columns make the order total
    cols += [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c not in dict(order)]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_by_priority(df: DataFrame, keys: Sequence[str], col: str, priorities: Sequence[str],
                      tie: Order = ()) -> DataFrame:
    """First per key by a category priority list; unknown categories last."""
    pr = F.array(*[F.lit(p) for p in priorities])
    rank = F.array_position(pr, F.col(col))
    tmp = df.withColumn("_prio", F.when(rank > 0, rank).otherwise(F.lit(len(priorities) + 1)))
    out = first_by(tmp, keys, [("_prio", "asc"), *tie])
    return out.drop("_prio")


def dedup_full(df: DataFrame) -> DataFrame:
    """Whole-row dedup."""
    return df.distinct()
