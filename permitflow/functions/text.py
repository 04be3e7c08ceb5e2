"""String helpers (C1/C2 building blocks, C8, C9, X6)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ASCII whitespace stripped by ``str.strip`` (``trim`` alone only removes spaces)
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(col) -> Column:
    """Strip all leading/trailing whitespace characters (character-set trim, no regex)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def title_words(col) -> Column:
    """Title case per word (``initcap``); equal to ``str.title`` on the closed
    vocabularies used here (no apostrophes or hyphens)."""
    return F.initcap(_c(col))


def fix_spacing(col, pos: int = 3) -> Column:
    """Collapse a double space that starts right after ``pos`` characters."""
    c = _c(col)
    return F.when(F.substring(c, pos + 1, 2) == F.lit("  "),
                  F.concat(F.substring(c, 1, pos), F.substr(c, F.lit(pos + 2)))).otherwise(c)


def replace_word(col, old: str, new: str) -> Column:
    return F.regexp_replace(_c(col), old, new)


def contains_text(col, text: str) -> Column:
    return _c(col).contains(text)
