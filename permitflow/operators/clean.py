"""Projection, filter and cleaning operators.

All are narrow transformations: no shuffle, codegen-friendly, and Catalyst can
push their filters into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ACTIVE_STATUSES, IN_PROCESS_STATUSES, SITE_CODE_PATTERN
from ..functions.text import strip_ws, title_words


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --- P: projections -------------------------------------------------------

def concat_label(cols: Sequence[str], sep: str = " ") -> Column:
    """``a + sep + b``; null if any part is null (string concatenation)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.col(c))
    return F.concat(*parts)


def assign_when(df: DataFrame, col: str, steps: Sequence[tuple[Column, Column]],
                default: Column | None = None) -> DataFrame:
    """A sequence of masked assignments ``df.loc[cond, col] = expr``.

    Later assignments win, so the ``when`` chain is built in reverse order and
    falls back to the current value (or ``default`` when the column is new).
    """
    base = default if default is not None else (F.col(col) if col in df.columns else F.lit(None))
    expr = None
    for cond, value in reversed(list(steps)):
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return df.withColumn(col, base if expr is None else expr.otherwise(base))


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


# --- F: filters -----------------------------------------------------------

def require(df: DataFrame, cols) -> DataFrame:
    """keep rows where every listed column is non-null."""
    cond = None
    for c in _cols(cols):
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_all_null(df: DataFrame, cols) -> DataFrame:
    """drop rows where all listed columns are null (NaN counts as null)."""
    return df.dropna(how="all", subset=_cols(cols))


def keep_any_positive(df: DataFrame, cols) -> DataFrame:
    """keep rows where any listed column is > 0."""
    cond = None
    for c in _cols(cols):
        cond = (F.col(c) > 0) if cond is None else cond | (F.col(c) > 0)
    return df.filter(F.coalesce(cond, F.lit(False)))


def nullify_nonpositive(df: DataFrame, cols) -> DataFrame:
    """values <= 0 become null."""
    return df.withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in _cols(cols)})


def status_class(col: str | Column = "ConsentStatus") -> Column:
    """'active' / 'in_process' / null for a permit status."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c.isin(*ACTIVE_STATUSES), F.lit("active"))
             .when(c.isin(*IN_PROCESS_STATUSES), F.lit("in_process")))


def keep_included(df: DataFrame, group_col: str, sw_flag: str | None, gw_flag: str | None,
                  sw_value: str = "Surface Water", gw_value: str = "Groundwater") -> DataFrame:
    """drop SW rows not included in SW allocation and GW rows not in GW allocation;
    a missing flag counts as included."""
    cond = F.lit(True)
    if gw_flag:
        cond = cond & ((F.col(group_col) != gw_value) | F.coalesce(F.col(gw_flag), F.lit(True)))
    if sw_flag:
        cond = cond & ((F.col(group_col) != sw_value) | F.coalesce(F.col(sw_flag), F.lit(True)))
    return df.filter(cond)


# --- C: cleaning ----------------------------------------------------------

def norm_key(df: DataFrame, cols) -> DataFrame:
    """Strip all whitespace + upper case."""
    return df.withColumns({c: F.upper(strip_ws(F.col(c))) for c in _cols(cols)})


def norm_label(df: DataFrame, cols) -> DataFrame:
    """Strip + title case."""
    return df.withColumns({c: title_words(strip_ws(F.col(c))) for c in _cols(cols)})


def strip_cols(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: strip_ws(F.col(c)) for c in _cols(cols)})


def validate_code(col: str | Column, pattern: str = SITE_CODE_PATTERN) -> Column:
    """Keep the value when the (unanchored) pattern occurs in it, else null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike(pattern), c)


def recode(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """C4: exact-value recode; other values pass through."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return c if expr is None else expr.otherwise(c)


def coerce_numeric(df: DataFrame, cols, digits: int | None = None, to: str = "double") -> DataFrame:
    """text/number -> number, unparsable -> null, optional half-even rounding."""
    out = {}
    for c in _cols(cols):
        v = F.col(c).try_cast(to)
        out[c] = F.bround(v, digits) if digits is not None else v
    return df.withColumns(out)


def coerce_int(df: DataFrame, cols) -> DataFrame:
    """Truncating integer cast (``astype(int)``); null stays null."""
    return df.withColumns({c: F.col(c).try_cast("double").cast("bigint") for c in _cols(cols)})


def coerce_date(df: DataFrame, cols) -> DataFrame:
    """Text -> date, unparsable -> null."""
    return df.withColumns({c: F.col(c).try_cast("date") for c in _cols(cols)})


FLAG_RULES = {
    # consented takes: null -> NO, COMPLEX -> YES; other text stays unknown
    "takes": {"null": "NO", "map": {"COMPLEX": "YES"}, "other": None},
    # diverts: anything but NO/YES -> YES
    "diverts": {"null": "NO", "map": {}, "other": "YES"},
}


def to_bool(col: str | Column, rules: str = "takes") -> Column:
    """Yes/No/Complex text -> boolean under one of two vocabularies."""
    r = FLAG_RULES[rules]
    c = F.upper(strip_ws(F.col(col) if isinstance(col, str) else col))
    c = F.coalesce(c, F.lit(r["null"]))
    for k, v in r["map"].items():
        c = F.when(c == k, F.lit(v)).otherwise(c)
    if r["other"] is not None:
        c = F.when(c.isin("NO", "YES"), c).otherwise(F.lit(r["other"]))
    return F.when(c == "YES", F.lit(True)).when(c == "NO", F.lit(False))


def include_flag(col: str | Column) -> Column:
    """N9: 'Yes'/'No'/null flag where null (and any other text) counts as included."""
    c = title_words(strip_ws(F.col(col) if isinstance(col, str) else col))
    return F.coalesce(c != F.lit("No"), F.lit(True))


def repair_dates(df: DataFrame, status_col: str, from_col: str, to_col: str,
                 s124_status: str = "Issued - s124 Continuance", years: int = 30,
                 floor: str = "1950-01-01", sentinel: str | None = "1900-01-01") -> DataFrame:
    """s124 continuance -> ToDate = FromDate + ``years``; dates before
    ``floor`` -> null; then null -> ``sentinel`` (when given)."""
    fd, td = F.col(from_col), F.col(to_col)
    td = F.when(F.col(status_col) == s124_status, F.add_months(fd, 12 * years)).otherwise(td)
    fl = F.lit(floor).cast("date")
    fd2 = F.when(fd < fl, F.lit(None).cast("date")).otherwise(fd)
    td2 = F.when(td < fl, F.lit(None).cast("date")).otherwise(td)
    if sentinel is not None:
        s = F.lit(sentinel).cast("date")
        fd2, td2 = F.coalesce(fd2, s), F.coalesce(td2, s)
    return df.withColumns({from_col: fd2, to_col: td2})


def round_int(df: DataFrame, cols) -> DataFrame:
    """C11: half-even round to integer."""
    return df.withColumns({c: F.bround(F.col(c)).cast("bigint") for c in _cols(cols)})


def rollup_codes(df: DataFrame, col: str, code_map: Mapping[str, Iterable[str]],
                 out: str | None = None, strict: bool = True) -> DataFrame:
    """Many codes -> one class. ``code_map`` is class -> codes (config sized).

    The lookup is a literal map expression (no join). With ``strict`` an
    unknown non-null code fails the job from inside the executors.
    """
    pairs = []
    for cls, codes in code_map.items():
        for code in codes:
            pairs += [F.lit(code), F.lit(cls)]
    mapped = F.try_element_at(F.create_map(*pairs), F.col(col))
    if strict:
        mapped = F.when(F.col(col).isNotNull() & mapped.isNull(),
                        F.raise_error(F.concat(F.lit("unknown code: "), F.col(col))).cast("string")
                        ).otherwise(mapped)
    return df.withColumn(out or col, mapped)
