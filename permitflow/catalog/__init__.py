"""Registered queries: one Spark callable per SURVEY §2 key, each paired (where
SQL can express it) with an oracle SQL text that DuckDB runs on the same
parquet tables. The oracle texts are independent re-statements of the rules,
not generated from the Spark plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.bindings import Tables, oracle_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, uses: tuple[str, ...] = (), sql: str | None = None, recursive: bool = False):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle SQL.

    ``uses`` lists the bindings the SQL needs; ``sql`` may start with extra
    CTEs (``name AS (...), ...`` followed by the final SELECT after a line
    holding only ``--``)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _compose(uses, sql, recursive)
        return fn
    return deco


def _compose(uses, sql: str, recursive: bool) -> str:
    if "\n--\n" in sql:
        ctes, final = sql.split("\n--\n", 1)
    else:
        ctes, final = "", sql
    head = oracle_ctes(list(uses)) if uses else ""
    if ctes.strip():
        head = (head.rstrip() + ",\n" if head else "WITH ") + ctes.strip() + "\n"
    if recursive and head:
        head = "WITH RECURSIVE " + head[len("WITH "):]
    return head + final.strip()


def load_all() -> None:
    from . import q_core, q_relational, q_domain  # noqa: F401
