"""Deletion neighbourhoods of lines for any edit bound (operator 8 with more than one edit).

Two lines are within ``edits`` word edits exactly when both become the same words by leaving some out, where left-out words at the same
gap may pair up as a change: with s changes, a words only the one line has and b only the other, s + a + b <= edits. So a line's
variants are all its words without up to ``edits`` of them, each with every choice of which left-out words are changes; a key is
the remaining words with the changes' gaps. Each key needs only its earliest line for each a.

Lines within the bound share one of ``edits`` + 1 parts of the shorter line, moved by at most ``edits`` places; only lines with a shared
part make variants. A line of m words makes about (2 m) ** edits / edits! of them, in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices
from .line_words import Sums, key, lines
from .storage import Scratch

CHUNK = 1 << 16


def _wanted_lines(batch: pa.RecordBatch):
    """(its prefix sums, (pos, first word, end) of each wanted line) of a batch of (text, wanted)."""
    words, first, text, number, _, _ = lines(batch.column("text"))
    line_of = {(int(t), int(n)): k for k, (t, n) in enumerate(zip(text, number))}
    at = [(w["pos"], line_of[i, w["line"]]) for i, wanted in enumerate(batch.column("wanted").to_pylist()) for w in wanted]
    return Sums(words), [(pos, int(first[k]), int(first[k + 1])) for pos, k in at]


def _parts(edits: int):
    """(key, pos): parts of each line as the shorter one of a pair, and where they may stand in it as the longer one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 128):
                sums, wanted = _wanted_lines(batch)
                if not wanted:
                    continue
                start, end = (np.array([w[i] for w in wanted]) for i in (1, 2))
                m, keys, rows = end - start, [], []
                for less in range(edits + 1):
                    length = m - less
                    for part in range(edits + 1):
                        a, b = length * part // (edits + 1), length * (part + 1) // (edits + 1)
                        for shift in range(-edits, edits + 1):
                            ok = np.flatnonzero((length > 0) & (a + shift >= 0) & (b + shift <= m))
                            s = start[ok] + shift
                            keys.append(key(sums.run(s + a[ok], s + b[ok]), length[ok], np.full(len(ok), part + 8)))
                            rows.append(ok)
                pos = pa.array([w[0] for w in wanted], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pos.take(pa.array(np.concatenate(rows)))], ["key", "pos"])
    return run


def _variants(edits: int):
    """(key, pos, changed, extra): every variant of the wanted lines."""
    def of_line(sums, start, end):
        for d in range(min(edits, end - start) + 1):
            places = combinations(range(start, end), d)
            while chunk := list(islice(places, CHUNK)):
                at = np.array(chunk, dtype=np.int64).reshape(len(chunk), d)
                h, before, kept = np.zeros(len(at), np.uint64), np.full(len(at), start), np.zeros(len(at), np.int64)
                with np.errstate(over="ignore"):
                    for j in range(d):
                        h = h + sums.run(before, at[:, j]) * sums.up[kept]
                        kept, before = kept + at[:, j] - before, at[:, j] + 1
                    h = h + sums.run(before, np.full(len(at), end)) * sums.up[kept]
                for s in range(d + 1):
                    for changes in combinations(range(d), s):
                        gaps = [at[:, j] - start - j for j in changes]
                        yield key(h, np.full(len(at), end - start - d), np.full(len(at), s + 16), *gaps), s, d - s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 128):
                sums, wanted = _wanted_lines(batch)
                for pos, start, end in wanted:
                    for keys, s, extra in of_line(sums, start, end):
                        n = len(keys)
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([pos] * n, pa.decimal128(38, 0)), pa.array(np.full(n, s, np.int8)),
                                                          pa.array(np.full(n, extra, np.int8))], ["key", "pos", "changed", "extra"])
    return run


def within(x: list, y: list, edits: int) -> bool:
    """Whether at most ``edits`` changes, insertions and removals turn ``x`` into ``y``."""
    if abs(len(x) - len(y)) > edits:
        return False
    i, n = 0, min(len(x), len(y))
    while i < n and x[i] == y[i]:
        i += 1
    k = 0
    while k < n - i and x[-1 - k] == y[-1 - k]:
        k += 1
    x, y, far = x[i:len(x) - k], y[i:len(y) - k], edits + 1
    row = {j: j for j in range(min(edits, len(y)) + 1)}
    for i, word in enumerate(x, 1):
        last, row = row, {}
        for j in range(max(0, i - edits), min(len(y), i + edits) + 1):
            best = min(last.get(j, far), row.get(j - 1, far)) + 1
            if j:
                best = min(best, last.get(j - 1, far) + (word != y[j - 1]))
            row[j] = min(best, far)
    return row.get(len(y), far) <= edits


def near_lines(firsts: DataFrame, source: DataFrame, edits: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((pos, by) of lines with the earliest line of lower place within the bound, (row, line, pos) of the lines looked at).

    ``firsts``: (row, line, pos) of the distinct lines, ``source``: (row, text)."""
    def dealt(lines: DataFrame) -> DataFrame:
        wanted = lines.groupBy("row").agg(F.collect_list(F.struct("line", "pos")).alias("wanted"))
        return source.select("row", "text").join(wanted.hint("merge"), "row").select("text", "wanted")
    parts = scratch.write(dealt(firsts).mapInArrow(_parts(edits), "key bigint, pos decimal(38,0)").distinct(), "parts")
    shared = parts.groupBy("key").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).filter("a < b").select("key")
    wanted = scratch.write(firsts.join(parts.join(shared, "key", "left_semi").select("pos").distinct(), "pos", "left_semi"), "wanted")
    ddl = "key bigint, pos decimal(38,0), changed tinyint, extra tinyint"
    variants = scratch.write(dealt(wanted).mapInArrow(_variants(edits), ddl).distinct(), "variants")
    by_key = variants.groupBy("key").agg(*[F.min(F.when(F.col("extra") == a, F.col("pos"))).alias(f"by{a}") for a in range(edits + 1)],
                                         F.count("*").alias("k")).filter("k > 1")
    room = F.lit(edits) - F.col("changed") - F.col("extra")
    by = F.least(*[F.when(room >= a, F.col(f"by{a}")) for a in range(edits + 1)])
    found = variants.join(by_key, "key").select("pos", by.alias("by")).filter("by < pos")
    return found.groupBy("pos").agg(F.min("by").alias("by")), wanted
