"""Join operators.

Join strategy is left to Catalyst + AQE: a side is broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked
bound), otherwise the join shuffles on its keys and AQE splits skewed
partitions. Explicit ``broadcast()`` is used only for frames built from config
lists, whose size is fixed by the configuration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _l(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def lookup(df: DataFrame, dim: DataFrame, on=None, how: str = "inner",
           left_on=None, right_on=None) -> DataFrame:
    """Equi-join on one or more keys; differently named keys are
    renamed to the left names first (so no duplicate key columns remain)."""
    if left_on is not None:
        lo, ro = _l(left_on), _l(right_on)
        dim = dim.withColumnsRenamed(dict(zip(ro, lo)))
        on = lo
    return df.join(dim, _l(on), how)


def lookup_fill(df: DataFrame, other: DataFrame, on, fill: dict) -> DataFrame:
    """Left join, then defaults for the unmatched rows."""
    out = df.join(other, _l(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def align_full(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Full outer join on keys (pandas index alignment)."""
    return a.join(b, _l(on), "full")


def join_with_indicator(a: DataFrame, b: DataFrame, on, indicator: str = "_merge") -> DataFrame:
    """Full outer join with a 'left_only' / 'right_only' / 'both' column."""
    la = a.withColumn("_in_l", F.lit(True))
    rb = b.withColumn("_in_r", F.lit(True))
    out = la.join(rb, _l(on), "full")
    ind = (F.when(F.col("_in_l").isNotNull() & F.col("_in_r").isNotNull(), F.lit("both"))
            .when(F.col("_in_l").isNotNull(), F.lit("left_only")).otherwise(F.lit("right_only")))
    return out.withColumn(indicator, ind).drop("_in_l", "_in_r")


def cross_dims(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Every row of ``df`` paired with each configured value.

    The value list comes from configuration (bounded), so the product is an
    ``explode`` of a literal array: a generator in one narrow stage, no join.
    """
    return df.withColumn(col, F.explode(F.array(*[F.lit(v) for v in values])))


def keep_existing(df: DataFrame, ref: DataFrame, on, ref_on=None) -> DataFrame:
    """Semi join (``isin``); null keys never match."""
    on = _l(on)
    if ref_on is not None:
        ref = ref.select(*[F.col(r).alias(o) for o, r in zip(on, _l(ref_on))])
    return df.join(ref.select(*on), on, "left_semi")


def missing_from(df: DataFrame, ref: DataFrame, on, ref_on=None) -> DataFrame:
    """Anti join (rows whose key is absent from ``ref``)."""
    on = _l(on)
    if ref_on is not None:
        ref = ref.select(*[F.col(r).alias(o) for o, r in zip(on, _l(ref_on))])
    return df.join(ref.select(*on), on, "left_anti")


def join_valid_on(events: DataFrame, spans: DataFrame, key, at: str, start: str, end: str,
                  drop_bounds: bool = True) -> DataFrame:
    """Events joined to the spans of the same key that contain ``at``.

    The equi-key drives the (shuffle or broadcast) join; the range is a
    post-join condition evaluated in the same stage.
    """
    key = _l(key)
    e, s = events.alias("e"), spans.alias("s")
    cond = [F.col(f"e.{k}") == F.col(f"s.{k}") for k in key]
    cond.append(F.col(f"e.{at}").between(F.col(f"s.{start}"), F.col(f"s.{end}")))
    keep = [F.col(f"e.{c}") for c in events.columns]
    keep += [F.col(f"s.{c}") for c in spans.columns if c not in key and (not drop_bounds or c not in (start, end))]
    return e.join(s, cond, "inner").select(*keep)


def expand_pairs(pairs: DataFrame, bridge: DataFrame, key_a: str, key_b: str, bridge_key: str,
                 carry: Sequence[str], suffix_b: str = "Other") -> DataFrame:
    """A pair table (A, B) expanded through the same bridge on both sides.

    Output rows are (A-member, B-member) for each pair: the size of the result
    is the table's definition (sum over pairs of |A| x |B|).
    """
    carry = list(carry)
    a = bridge.select(F.col(bridge_key).alias(key_a), *[F.col(c) for c in carry])
    b = bridge.select(F.col(bridge_key).alias(key_b), *[F.col(c).alias(f"{suffix_b}{c}") for c in carry])
    return pairs.join(a, key_a, "inner").join(b, key_b, "inner")


def star_lookup(fact: DataFrame, dims: Sequence[tuple[DataFrame, object, Sequence[str]]]) -> DataFrame:
    """Chain of dimension lookups ``(dim, on, drop_after)``."""
    out = fact
    for dim, on, drop in dims:
        out = out.join(dim, _l(on), "inner")
        if drop:
            out = out.drop(*drop)
    return out


def lookup_distinct(df: DataFrame, ref: DataFrame, on, cols: Sequence[str]) -> DataFrame:
    """Join to a distinct projection of ``ref``."""
    on = _l(on)
    return df.join(ref.select(*on, *cols).distinct(), on, "inner")
