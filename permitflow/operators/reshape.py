"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _l(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --- U: set operations ----------------------------------------------------

def union_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union of two value sets (by column name)."""
    return a.unionByName(b).distinct()


def difference(a: DataFrame, b: DataFrame, on=None) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (anti join; null never matches)."""
    on = _l(on) if on else a.columns
    return a.join(b.select(*on), on, "left_anti")


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation of frames with differing columns (missing -> null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# --- R: reshape -----------------------------------------------------------

def to_long(df: DataFrame, ids, cols, name: str = "variable", value: str = "value",
            drop_null: bool = True) -> DataFrame:
    """Wide -> long (pandas ``stack``, which drops nulls).

    A generator, other than ``unpivot``, leaves the rows dealt as they are, so what is grouped next is not dealt again."""
    out = df.select(*_l(ids), F.inline(F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in _l(cols)])))
    return out.filter(F.col(value).isNotNull()) if drop_null else out


def to_wide(df: DataFrame, ids, name: str, value: str, values: Sequence[str]) -> DataFrame:
    """R2: long -> wide for a fixed list of attribute names."""
    return df.groupBy(*_l(ids)).pivot(name, list(values)).agg(F.min(value))


def split_by_flags(df: DataFrame, keep: Sequence[str],
                   branches: Sequence[tuple[Column, str, dict[str, Column]]],
                   label_col: str) -> DataFrame:
    """One input row -> 0..n output rows, one per branch whose condition holds.

    ``branches`` are ``(condition, label, {out_col: expr})``; all branches must
    produce the same output columns. Built as ``explode(filter(array(struct)))``
    so it stays one narrow stage.
    """
    out_cols = list(branches[0][2].keys())
    structs = []
    for cond, label, cols in branches:
        structs.append(F.struct(F.coalesce(cond, F.lit(False)).alias("_k"), F.lit(label).alias(label_col),
                                *[cols[c].alias(c) for c in out_cols]))
    arr = F.filter(F.array(*structs), lambda s: s["_k"])
    return (df.select(*keep, F.explode(arr).alias("_b"))
              .select(*keep, F.col("_b")[label_col].alias(label_col),
                      *[F.col("_b")[c].alias(c) for c in out_cols]))


def month_list(from_col, to_col, wrap: str = "reference") -> Column:
    """Months covered by a season. ``wrap='reference'``: a season with
    from > to keeps only 1..to (reference behaviour); ``'full'``: from..12 + 1..to."""
    f = F.col(from_col) if isinstance(from_col, str) else from_col
    t = F.col(to_col) if isinstance(to_col, str) else to_col
    if wrap == "full":
        wrapped = F.concat(F.sequence(f, F.lit(12)), F.sequence(F.lit(1), t))
    else:
        wrapped = F.sequence(F.lit(1), t)
    return F.when(f > t, wrapped).otherwise(F.sequence(f, t))


def explode_months(df: DataFrame, from_col: str, to_col: str, out: str = "Month",
                   wrap: str = "reference", drop_bounds: bool = True) -> DataFrame:
    """One row per month of the season (see ``month_list``)."""
    out_df = df.withColumn(out, F.explode(month_list(from_col, to_col, wrap)))
    return out_df.drop(from_col, to_col) if drop_bounds else out_df


def month_count(from_col, to_col, wrap: str = "reference") -> Column:
    """Closed form of ``size(month_list(..))``: the weight used instead of exploding."""
    f = F.col(from_col) if isinstance(from_col, str) else from_col
    t = F.col(to_col) if isinstance(to_col, str) else to_col
    wrapped = (F.lit(12) - f + F.lit(1) + t) if wrap == "full" else t
    return F.when(f > t, wrapped).otherwise(t - f + F.lit(1))


def month_bounds(from_col, to_col, wrap: str = "reference") -> tuple[Column, Column]:
    """Closed form of min/max of ``month_list``."""
    f = F.col(from_col) if isinstance(from_col, str) else from_col
    t = F.col(to_col) if isinstance(to_col, str) else to_col
    if wrap == "full":
        return F.when(f > t, F.lit(1)).otherwise(f), F.when(f > t, F.lit(12)).otherwise(t)
    return F.when(f > t, F.lit(1)).otherwise(f), t


def month_ffill(df: DataFrame, keys, month: str, value: str, out_month: str = "Month",
                active_to: str | None = None) -> DataFrame:
    """Sum per (keys, month), densify to months 1..12, forward fill, drop
    leading gaps (reference ``split_months``: a later season *replaces* the
    earlier value).

    With ``active_to`` (option ``active_months``) the value instead counts in
    every month from ``month`` to ``active_to`` and months are summed.

    Plan: a partial aggregate on (keys, month) removes skew, then each key
    holds at most 12 entries, so the per-key array built by the second
    aggregate is bounded; the fill runs as array functions inside one row.
    """
    keys = _l(keys)
    if active_to is not None:
        ex = df.withColumn("_m", F.explode(F.sequence(F.col(month), F.col(active_to))))
        return (ex.groupBy(*keys, F.col("_m").alias(out_month))
                  .agg(F.coalesce(F.sum(value), F.lit(0)).alias(value)))
    sums = df.groupBy(*keys, month).agg(F.sum(value).alias("_v"))
    per_key = sums.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(month).cast("int"), F.col("_v")))).alias("_m"))
    filled = F.aggregate(
        F.sequence(F.lit(1), F.lit(12)),
        F.array().cast("array<double>"),
        lambda acc, i: F.concat(acc, F.array(F.coalesce(F.try_element_at(F.col("_m"), i).cast("double"),
                                                         F.try_element_at(acc, F.lit(-1))))))
    return (per_key.select(*keys, F.posexplode(filled).alias("_p", value))
                   .filter(F.col(value).isNotNull())
                   .select(*keys, (F.col("_p") + 1).alias(out_month), value))
