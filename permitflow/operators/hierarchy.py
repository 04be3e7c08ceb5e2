"""Permit hierarchy operators (H1, H2).

H1 looks for the nearest relatives with a value. It keeps one label per permit: the distance to the nearest relative
that has a value, the least such value at that distance, and whose it is. Labels spread against the edges while chains of
permits are cut short: an edge to a permit that has a single edge left itself is replaced by an edge past it, so a
chain of n edges takes about log2(n) rounds. Edges that can no longer shorten a label are dropped. What may be left are
cycles of permits with several edges each; there labels are passed on until none changes.

Each round writes two tables (edges, labels) in the shared checkpoint folder (``spark.checkpoint.dir``), which cuts
lineage: a lost executor recomputes one round. The stop test reads counts observed during these writes; nothing else
reaches the driver.
"""

from __future__ import annotations

import logging
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip_ws
from ..session import ensure_checkpoint_dir, materialize, materialize_counted

log = logging.getLogger(__name__)


def clean_edges(edges: DataFrame, nodes: DataFrame, parent: str = "ParentRecordNumber",
                child: str = "ChildRecordNumber", node_key: str = "RecordNumber") -> DataFrame:
    """H2: normalise both ends (strip + upper), drop null ends, dedup, and keep
    edges whose two ends exist in ``nodes``."""
    e = edges.withColumns({parent: F.upper(strip_ws(parent)), child: F.upper(strip_ws(child))})
    e = e.filter(F.col(parent).isNotNull() & F.col(child).isNotNull()).distinct()
    keys = nodes.select(node_key).distinct()
    e = e.join(keys.withColumnRenamed(node_key, parent), parent, "left_semi")
    return e.join(keys.withColumnRenamed(node_key, child), child, "left_semi").select(*edges.columns)


def _checksum(*cols: str) -> Column:
    """A sum that tells two states of a table apart."""
    return F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))


def _least(labels: DataFrame) -> DataFrame:
    """The least label (d, v, s) of each node: distance, value, whose value."""
    return labels.groupBy("n").agg(F.min(F.struct("d", "v", "s")).alias("l")).select("n", "l.*")


def _pruned(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The shortest of parallel edges, without those that can't give their parent a label as good as its own."""
    e = edges.filter("p <> c").groupBy("p", "c").agg(F.min("w").alias("w"))
    own = labels.select(F.col("n").alias("p"), F.col("d").alias("_own"))
    return e.join(own, "p", "left").filter(F.col("_own").isNull() | (F.col("w") + 1 <= F.col("_own"))).drop("_own")


def nearest_labels(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(n, d, v, s) for each node without a value of its own that reaches one: the least label over all its paths.

    ``edges``: (p, c), written and distinct; ``known``: (n, v), the least value of each node that has one.
    """
    own = known.select(F.col("n").alias("c"), "v")
    open_edges = edges.join(known.select(F.col("n").alias("p")), "p", "left_anti")
    met = open_edges.join(own, "c", "left").withColumn("w", F.lit(1).cast("bigint"))
    labels = _least(met.filter("v IS NOT NULL").select(F.col("p").alias("n"), F.col("w").alias("d"), "v", F.col("c").alias("s")))
    labels = materialize(labels, "walk-labels0")
    edges_now, n = materialize_counted(_pruned(met.filter("v IS NULL").select("p", "c", "w"), labels), "walk-edges0", n=F.count("*"))
    nodes, before = n["n"] + 1, None  # no shortest path is longer than the number of open edges
    for step in count(1):
        if not n["n"]:
            return labels
        # what a child knows: its label, whether it is settled (has no open edge), and its only open edge
        out = edges_now.groupBy(F.col("p").alias("c")).agg(F.count("*").alias("k"), F.min("c").alias("to"), F.min("w").alias("far"))
        e = edges_now.join(out, "c", "left").join(labels.select(F.col("n").alias("c"), "d", "v", "s"), "c", "left")
        e = materialize(e, f"walk-step{step}")
        passed = e.filter("d IS NOT NULL").select(F.col("p").alias("n"), (F.col("d") + F.col("w")).alias("d"), "v", "s")
        past = e.filter("k = 1").select("p", F.col("to").alias("c"), (F.col("w") + F.col("far")).alias("w")).filter(F.col("w") <= nodes)
        kept = e.filter("k > 1").select("p", "c", "w")
        labels, of_labels = materialize_counted(_least(labels.unionByName(passed)), f"walk-labels{step}", n=F.count("*"), sum=_checksum("n", "d", "v", "s"))
        edges_now, n = materialize_counted(_pruned(past.unionByName(kept), labels), f"walk-edges{step}", n=F.count("*"), sum=_checksum("p", "c", "w"))
        log.info("walk round %d: %d open edges", step, n["n"])
        if (of_labels, n) == before:  # only cycles of branching nodes are left, and their labels have settled
            return labels
        before = (of_labels, n)


def nearest_relative_value(rows: DataFrame, edges: DataFrame, key: str = "RecordNumber",
                           value: str = "WAP", parent: str = "ParentRecordNumber",
                           child: str = "ChildRecordNumber", nodes: DataFrame | None = None) -> DataFrame:
    """For every key having a row with a null ``value``: ``(key, value)`` with the least value among the nearest
    descendants that have one, where there are any; the key itself is no relative of its own, even on a cycle.

    With ``nodes`` only rows whose key is among them count; they meet the keys, not the rows."""
    ensure_checkpoint_dir(rows.sparkSession)
    # read by every step: each key with its least value, and whether a row lacks one, is written once
    keys = rows.select(F.col(key).alias("n"), F.col(value).alias("v")).filter("n IS NOT NULL").groupBy("n").agg(
        F.min("v").alias("v"), F.max(F.col("v").isNull()).alias("missing"))
    if nodes is not None:
        keys = keys.join(nodes.select(F.col(key).alias("n")), "n", "left_semi")
    keys = materialize(keys, "walk-keys")
    seeds = keys.filter("missing").select("n")
    known = keys.filter("v IS NOT NULL").select("n", "v")
    e = materialize(edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).filter("p <> c").distinct(), "walk-edges")
    labels = nearest_labels(e, known)
    every = labels.unionByName(known.select("n", F.lit(0).cast("bigint").alias("d"), "v", F.col("n").alias("s")))
    of_child = every.withColumnRenamed("n", "c")
    best = _least(e.join(seeds.withColumnRenamed("n", "p"), "p", "left_semi").join(of_child, "c").select(F.col("p").alias("n"), (F.col("d") + 1).alias("d"), "v", "s"))
    best = materialize(best, "walk-best")
    out = best.filter("s <> n")
    # keys with values of their own on a cycle back to themselves: their own value may hide another relative's
    hidden = best.filter("s = n").select("n")
    if not hidden.isEmpty():
        out = out.unionByName(_beside_own(hidden, e, known).select(*out.columns))
    return out.select(F.col("n").alias(key), F.col("v").alias(value))


def _beside_own(keys: DataFrame, edges: DataFrame, known: DataFrame) -> DataFrame:
    """(n, d, v, s) of these keys, level by level from each, without the key itself.

    Only keys whose nearest value is their own come here, and each goes on to the next relative with a value.
    """
    keys = materialize(keys, "walk-hidden")
    others = known.select(F.col("n").alias("m"), "v")
    front = materialize(keys.select("n", F.col("n").alias("m")), "walk-front0")
    seen, found = front, None
    for level in count(1):
        step = front.join(edges.withColumnRenamed("p", "m"), "m").select("n", F.col("c").alias("m")).distinct().join(seen, ["n", "m"], "left_anti")
        step = materialize(step.join(others, "m", "left"), f"walk-front{level}")
        hits = step.filter("v IS NOT NULL").groupBy("n").agg(F.min(F.struct("v", "m")).alias("h"))
        hits = materialize(hits.select("n", F.lit(level).cast("bigint").alias("d"), "h.v", F.col("h.m").alias("s")), f"walk-hits{level}")
        found = hits if found is None else found.unionByName(hits)
        front, n = materialize_counted(step.join(hits.select("n"), "n", "left_anti").select("n", "m"), f"walk-next{level}", n=F.count("*"))
        if not n["n"]:
            return found
        seen = seen.unionByName(front)


def fill_from_relatives(rows: DataFrame, edges: DataFrame, key: str = "RecordNumber",
                        value: str = "WAP", parent: str = "ParentRecordNumber",
                        child: str = "ChildRecordNumber", only_missing: bool = False, nodes: DataFrame | None = None) -> DataFrame:
    """H1: fill a missing value from the nearest relatives.

    By default the found value is written to *all* rows of the key (reference
    parity); ``only_missing=True`` keeps existing non-null values. With ``nodes`` rows of other keys are left out; the
    rows are then dealt by key once, and stay so.
    """
    fills = nearest_relative_value(rows, edges, key, value, parent, child, nodes)
    fills = fills.withColumnRenamed(value, "_fill")
    if nodes is not None:
        rows = rows.repartition(key).join(nodes.select(key), key, "left_semi")
    out = rows.join(fills, key, "left")
    if only_missing:
        new = F.coalesce(F.col(value), F.col("_fill"))
    else:
        new = F.coalesce(F.col("_fill"), F.col(value))
    return out.withColumn(value, new).drop("_fill").select(*rows.columns)
