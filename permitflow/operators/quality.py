"""Data-quality operators (Q1-Q5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def check_config(code_map: Mapping[str, Sequence[str]], priorities: Sequence[str]) -> None:
    """Q1: every use class of the code map must have a priority."""
    missing = sorted(set(code_map) - set(priorities))
    if missing:
        raise ValueError(f"use-type priorities do not cover: {missing}")


def check_constraints(df: DataFrame, pk: Sequence[str], fks: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = (),
                      not_null: Sequence[str] = ()) -> DataFrame:
    """Q2: violations as rows ``(rule, key..., n)``: duplicate or null primary
    keys, foreign keys absent from their parent, nulls in required columns.
    Each rule is one aggregate or anti join; nothing is collected."""
    pk = list(pk)
    keycols = [F.col(c).cast("string").alias(c) for c in pk]
    parts = [df.groupBy(*pk).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
             .select(F.lit("pk_duplicate").alias("rule"), *keycols, "n")]
    null_pk = None
    for c in pk:
        null_pk = F.col(c).isNull() if null_pk is None else null_pk | F.col(c).isNull()
    parts.append(df.filter(null_pk).groupBy(*pk).agg(F.count("*").alias("n")).select(F.lit("pk_null").alias("rule"), *keycols, "n"))
    for cols, parent, parent_cols in fks:
        ref = parent.select(*[F.col(p).alias(c) for c, p in zip(cols, parent_cols)]).distinct()
        whole = F.lit(True)  # a key with any null part refers to nothing
        for c in cols:
            whole = whole & F.col(c).isNotNull()
        bad = df.filter(whole).join(ref, list(cols), "left_anti")
        parts.append(bad.groupBy(*pk).agg(F.count("*").alias("n")).select(F.lit("fk_missing:" + ",".join(cols)).alias("rule"), *keycols, "n"))
    for c in not_null:
        parts.append(df.filter(F.col(c).isNull()).groupBy(*pk).agg(F.count("*").alias("n"))
                     .select(F.lit(f"null:{c}").alias("rule"), *keycols, "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def band_class(min_col: str = "MinAllocation", max_col: str = "MaxAllocation"):
    """Q4: trigger-band anomaly class (rules inferred from the exported reports)."""
    mn, mx = F.col(min_col), F.col(max_col)
    return (F.when(mx < 100, F.lit("max_allo_under_100"))
             .when((mn == 100) & (mx > 100), F.lit("min_allo_equals_100"))
             .when((mn < 100) & (mx > 100), F.lit("min_allo_less_than_100")))


def check_codes(df: DataFrame, col: str, code_map: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q5: distinct codes of ``col`` missing from the code map."""
    known = [c for codes in code_map.values() for c in codes]
    return df.select(col).distinct().filter(F.col(col).isNotNull() & ~F.col(col).isin(known))
