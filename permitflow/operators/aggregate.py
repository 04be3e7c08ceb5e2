"""Grouped aggregation operators.

Aggregates broadcast back to rows (A4/A5) are a grouped aggregate joined back
on the keys rather than a window: the aggregate is partial (map-side) and the
join of a hot key is split by AQE's skew handling, whereas a window would sort
the whole hot group inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def _l(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_non_null(col: str, ordinal: str) -> Column:
    """First non-null value in input order (``ordinal`` gives the order)."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(ordinal)))


def exact_mean(col: str, weight: str | None = None, digits: int = 2, scale: int = 6) -> Column:
    """Weighted mean rounded half-even on exact decimals.

    Inputs are first rounded to ``scale`` decimals and summed as decimals, so
    a mean that is mathematically on a half (7.725) rounds to even no matter
    in which order executors add the partial sums; float sums would land on
    either side of the half depending on the order.
    """
    x = F.bround(F.col(col), scale).cast(f"decimal(28,{scale})")
    w = F.col(weight) if weight else F.lit(1)
    num = F.sum(x * w)
    den = F.sum(F.when(F.col(col).isNotNull(), w))
    return F.bround(F.try_divide(num, den), digits).cast("double")


def season_stats(df: DataFrame, keys, means: Sequence[str], month: str = "Month",
                 firsts: Sequence[str] = (), ordinal: str | None = None, digits: int = 2,
                 weight: str | None = None) -> DataFrame:
    """A1: per group: half-even rounded means, min/max month, first non-null under ``ordinal`` (needed for ``firsts``).

    With ``weight`` each row stands for ``weight`` month rows (closed form of
    the month explode): mean = sum(x * w) / sum(w where x not null).
    """
    if firsts and ordinal is None:
        raise ValueError("firsts need an ordinal: rows have no order of their own")
    aggs = [exact_mean(c, weight, digits).alias(c) for c in means]
    if isinstance(month, tuple):
        lo, hi = month
        aggs += [F.min(lo).alias("FromMonth"), F.max(hi).alias("ToMonth")]
    else:
        aggs += [F.min(month).alias("FromMonth"), F.max(month).alias("ToMonth")]
    for c in firsts:
        aggs.append(first_non_null(c, ordinal).alias(c))
    return df.groupBy(*_l(keys)).agg(*aggs)


def group_sum(df: DataFrame, keys, cols, zero_if_empty: bool = True) -> DataFrame:
    """A2: group sum; all-null sums are 0 like pandas."""
    aggs = [(F.coalesce(F.sum(c), F.lit(0)) if zero_if_empty else F.sum(c)).alias(c) for c in _l(cols)]
    return df.filter(_keys_not_null(keys)).groupBy(*_l(keys)).agg(*aggs)


def group_min(df: DataFrame, keys, cols=None) -> DataFrame:
    """A3: group min over the given (default: all remaining) columns."""
    keys = _l(keys)
    cols = _l(cols) if cols is not None else [c for c in df.columns if c not in keys]
    return df.filter(_keys_not_null(keys)).groupBy(*keys).agg(*[F.min(c).alias(c) for c in cols])


def _keys_not_null(keys) -> Column:
    cond = F.lit(True)
    for k in _l(keys):
        cond = cond & F.col(k).isNotNull()
    return cond


def with_group_count(df: DataFrame, keys, col: str, out: str) -> DataFrame:
    """A4: non-null count of ``col`` per group, attached to every row."""
    keys = _l(keys)
    counts = df.groupBy(*keys).agg(F.count(col).alias(out))
    return df.join(counts, keys, "left")


def with_group_sum(df: DataFrame, keys, col: str, out: str) -> DataFrame:
    """A5: group sum attached to every row (pandas ``transform('sum')``)."""
    keys = _l(keys)
    sums = df.groupBy(*keys).agg(F.coalesce(F.sum(col), F.lit(0)).alias(out))
    return df.join(sums, keys, "left")


def joint_label(df: DataFrame, key: str, col: str, sep: str = ", ", out: str = "joint",
                count_out: str = "unit_count") -> DataFrame:
    """Per key, the sorted distinct members joined by ``sep`` when there is
    more than one member, else ''. Members are first reduced to distinct
    (key, member) pairs so the per-key list only holds distinct members."""
    members = df.select(key, col).filter(F.col(key).isNotNull() & F.col(col).isNotNull()).distinct()
    return (members.groupBy(key)
            .agg(F.count(col).alias(count_out),
                 F.array_join(F.array_sort(F.collect_list(col)), sep).alias("_j"))
            .withColumn(out, F.when(F.col(count_out) > 1, F.col("_j")).otherwise(F.lit("")))
            .drop("_j"))


def with_exists(df: DataFrame, other: DataFrame, key: str, value: str, out: str,
                other_key: str | None = None) -> DataFrame:
    """True where ``other`` has a non-null mean of ``value`` for the key."""
    ok = other_key or key
    means = (other.filter(F.col(value).isNotNull()).groupBy(ok).agg(F.avg(value).alias("_m"))
             .filter(F.col("_m").isNotNull()).select(F.col(ok).alias(key), F.lit(True).alias(out)))
    return df.join(means, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def distinct_values(df: DataFrame, cols, drop_null: bool = True) -> DataFrame:
    """Distinct values of the columns (``unique()`` drops nothing; the
    reference removes nulls afterwards, which ``drop_null`` mirrors)."""
    out = df.select(*_l(cols)).distinct()
    return out.dropna(how="any") if drop_null else out


def observed_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by the next action on ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
