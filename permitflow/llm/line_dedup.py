"""Operator 8: near-duplicate lines by a deletion-neighbourhood join.

A line is its words (``[^\\x20\\x09-\\x0D]+``); blank lines are left alone. Lines with equal words are one distinct line,
which stands where it occurs first (document, then line number). Two distinct lines of at least ``min_words`` words
match when ``edits`` edits of words (changes, insertions or removals; 1 unless said otherwise) turn one into the other. A line is dropped when an
equal or matching line stands earlier.

With a bound of one edit, each line's neighbourhood is the set of its variants with one word deleted, as hashed keys:

* the same variant from the same place of two equally long lines: they differ in that word;
* a variant equal to a whole line: that line lacks one word.

Either way equal keys are matches, so each key needs only its earliest line: groups are reduced by partial
aggregates and no pairs are made. As at most one word differs, either the first or the last half of two matching
lines agree; keys of the halves are counted first, and only lines with a shared half send variants, from the other
half. The match that is found is then verified word by word.

Larger bounds take the general form in ``line_neighbours``, whose variants grow as the line's length to the power of the bound.

Documents are rows, in the order of their ids; rows with one id, or with null ids after all others, stand in the order
in which they are read. Up to 2**31 rows may have ids that are repeated; beyond that the run fails.

Defined results: null or empty text has no lines. Each row has one row in the report and its own lines, whatever its id. An
empty table gives an empty result. Extra columns of any name stay. Ids are cast to bigint.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .batches import default_parallelism, slices
from .expressions import let
from .line_neighbours import near_lines, within
from .line_words import Sums, key, lines as lines_of
from .shingles import mix
from .storage import Scratch

MIN_WORDS = 6


def _occurrences(min_words: int):
    """(row, id, line, h, h2, m, halves): a row for each non-blank line; halves: keys of its halves at lengths m and m-1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, first, text, number, _, _ = lines_of(batch.column("text"))
                start, end = first[:-1], first[1:]
                m, sums, again = end - start, Sums(words), Sums(mix(words + np.uint64(99)))
                halves = np.zeros((len(m), 4), dtype=np.int64)
                for k, length in enumerate((m, m - 1)):
                    p = length // 2
                    halves[:, 2 * k] = key(sums.run(start, start + p), length, np.full(len(m), 1))
                    halves[:, 2 * k + 1] = key(sums.run(end - (length - p), end), length, np.full(len(m), 2))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * 4), pa.array(halves.ravel()))
                long = pa.array(m >= min_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(text)), batch.column("id").take(pa.array(text)), pa.array(number.astype(np.int32)), pa.array(key(sums.run(start, end), m)),
                     pa.array(key(again.run(start, end), m)), pa.array(m.astype(np.int32)),
                     pa.compute.if_else(long, lists, pa.nulls(len(m), lists.type))], ["row", "id", "line", "h", "h2", "m", "halves"])
    import pyarrow.compute  # noqa: F401  (pa.compute)
    return run


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, role, line_key, at) of the wanted lines. role A: changed word, D: removed word, S: whole line."""
    names = ["key", "role", "pos", "at"]
    for whole in batches:
        for batch in slices(whole, 128):
            words, first, text, number, _, _ = lines_of(batch.column("text"))
            sums = Sums(words)
            line_of = {(int(t), int(n)): k for k, (t, n) in enumerate(zip(text, number))}
            keys, roles, poses, ats = [], [], [], []
            for i, wanted in enumerate(batch.column("wanted").to_pylist()):
                for w in wanted:
                    k = line_of[i, w["line"]]
                    s, e = int(first[k]), int(first[k + 1])
                    m = e - s
                    for which in w["which"]:
                        length = m if which < 2 else m - 1
                        p = length // 2
                        # the half that is not shared: after the first p words, or before the last length - p
                        places = np.arange(s + p, e) if which % 2 == 0 else np.arange(s, e - (length - p))
                        h = sums.without(s, e, places)
                        if which < 2:
                            keys += [key(h, m, places - s, 3), key(sums.run(s, e).reshape(1), m, 4)]
                            roles += [np.zeros(len(places), np.int8), np.full(1, 2, np.int8)]
                            ats += [places - s, np.full(1, -1)]
                            poses.append((w["pos"], len(places) + 1))
                        else:
                            keys.append(key(h, length, 4))
                            roles.append(np.ones(len(places), np.int8))
                            ats.append(places - s)
                            poses.append((w["pos"], len(places)))
            if keys:
                pos = [p for p, n in poses for _ in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(roles)), pa.array(pos, pa.decimal128(38, 0)),
                     pa.array(np.concatenate(ats).astype(np.int32))], names)


def _ordered(occ: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """``occ`` with ``own``, the place of each line as one number, so that a hash aggregate can take its minimum.

    ``ids``: (row, id) of all documents. Of ids that several rows have, and of null ids, the rows are numbered.
    """
    repeated = ids.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1 OR id IS NULL").select("id")
    rows = ids.join(repeated, ids["id"].eqNullSafe(repeated["id"]), "left_semi")
    rows = scratch.write(rows.select("row").repartitionByRange(default_parallelism(occ.sparkSession), "row").sortWithinPartitions("row")
                         .select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "repeated")
    unit, base = F.lit(2**31).cast("decimal(11,0)"), F.coalesce(F.col("id").cast("decimal(20,0)"), F.lit(Decimal(2**63)))
    number = F.lit(0)
    if not rows.isEmpty():
        parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))  # a row for each part
        parts = parts.select("part", "first", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        numbers = rows.join(parts, "part").select("row", (F.col("at") - F.col("first") + F.col("before")).alias("number"))
        known = F.when(F.col("id").isNull() | (F.col("number") < 2**31), F.col("number")).when(
            F.col("number").isNotNull(), F.raise_error(F.lit("more than 2**31 rows have repeated ids")).cast("bigint"))
        occ, number = occ.join(numbers.hint("merge"), "row", "left"), F.coalesce(known, F.lit(0))
    place = (base * unit + number.cast("decimal(20,0)")).cast("decimal(34,0)") * unit + F.col("line")
    return occ.withColumn("own", place.cast("decimal(38,0)")).drop("number")


def _near_by_one(firsts: DataFrame, source: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((pos, by) of lines with the earliest line that one edit turns into them, (row, line, pos) of the lines looked at)."""
    halves = firsts.select("row", "line", "pos", F.posexplode("halves").alias("which", "half"))
    shared = halves.groupBy("half").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).filter("a < b").select("half")
    wanted = (halves.join(shared, "half", "left_semi").groupBy("row", "line", "pos").agg(F.collect_set("which").alias("which"))
              .groupBy("row").agg(F.collect_set(F.struct("line", "pos", "which")).alias("wanted")))
    wanted = scratch.write(wanted, "wanted")
    # a sort-merge join at every size: the texts are dealt by row once
    texts = source.select("row", "text").join(wanted.hint("merge"), "row").select("text", "wanted")
    variants = scratch.write(texts.mapInArrow(_variants, "key bigint, role tinyint, pos decimal(38,0), at int").distinct(), "variants")
    by_key = variants.groupBy("key").agg(*[F.min(F.when(F.col("role") == r, F.col("pos"))).alias(n) for r, n in ((0, "a"), (1, "d"), (2, "s"))],
                                         F.count("*").alias("k")).filter("k > 1")
    found = variants.join(by_key, "key").select(
        "pos", F.when(F.col("role") == 0, F.col("a")).when(F.col("role") == 1, F.col("s")).otherwise(F.col("d")).alias("by")).filter("by < pos")
    return found.groupBy("pos").agg(F.min("by").alias("by")), wanted.select("row", F.inline("wanted")).select("row", "line", "pos")


def _found(docs: DataFrame, id_col: str, text_col: str, min_words: int, edits: int) -> tuple[DataFrame, str, DataFrame]:
    """(``docs`` with a number for each row, that column's name, (row, line, kind) of every line to drop)."""
    if edits < 1:
        raise ValueError("the edit bound is at least 1")
    scratch = Scratch(docs.sparkSession, "lines")
    keyed, row = scratch.keyed(docs)
    source = keyed.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    occ = source.mapInArrow(_occurrences(min_words), "row bigint, id bigint, line int, h bigint, h2 bigint, m int, halves array<bigint>")
    occ = _ordered(scratch.write(occ, "occurrences"), source.select("row", "id"), scratch)
    distinct = scratch.write(occ.groupBy("h", "h2", "m").agg(F.min("own").alias("pos"), F.count("*").alias("k")), "distinct")
    firsts = occ.withColumnRenamed("own", "pos").filter("halves IS NOT NULL").join(distinct.select("h", "h2", "m", "pos"), ["h", "h2", "m", "pos"])
    if edits == 1:
        near, wanted = _near_by_one(firsts, source, scratch)
    else:
        near, wanted = near_lines(firsts.select("row", "line", "pos"), source, edits, scratch)
    near = _verified(near, wanted, source, scratch, edits)
    dropped = (occ.join(distinct, ["h", "h2", "m"]).join(near.select("pos", F.lit(True).alias("near")), "pos", "left")
               .select("row", "line", F.when(F.col("own") > F.col("pos"), "exact").when(F.col("near"), "near").alias("kind")))
    return keyed, row, dropped.filter("kind IS NOT NULL")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edits: int = 1) -> DataFrame:
    """(id, line, kind) of every line to drop: kind ``exact`` or ``near``; lines count from 0."""
    keyed, row, lines = _found(docs, id_col, text_col, min_words, edits)
    ids = keyed.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias(id_col))
    return lines.join(ids, "row").select(id_col, "line", "kind")


def _checked(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [within(x.split(), y.split(), edits) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("pos"), batch.column("by"), pa.array(ok, pa.bool_())], ["pos", "by", "ok"])
    return run


def _verified(near: DataFrame, lines: DataFrame, source: DataFrame, scratch: Scratch, edits: int) -> DataFrame:
    """The (pos, by) pairs whose lines are within the bound; ``lines`` says where each place is to be read."""
    near = scratch.write(near, "near")
    places = near.select("pos").unionByName(near.select(F.col("by").alias("pos"))).distinct()
    places = places.join(lines, "pos").groupBy("row").agg(F.collect_list(F.struct("pos", "line")).alias("at"))
    texts = source.select("row", "text").join(places.hint("merge"), "row")
    taken = let(F.split("text", "\n"), lambda l: F.transform("at", lambda p: F.struct(p["pos"].alias("pos"), F.get(l, p["line"]).alias("words"))))
    words = texts.select(F.inline(taken))
    pairs = (near.join(words.withColumnRenamed("words", "x"), "pos")
             .join(words.withColumnsRenamed({"pos": "by", "words": "y"}), "by").select("pos", "by", F.encode("x", "UTF-8").alias("x"), F.encode("y", "UTF-8").alias("y")))
    checked = pairs.mapInArrow(_checked(edits), "pos decimal(38,0), by decimal(38,0), ok boolean")
    return checked.filter("ok").select("pos", "by")


def _per_row(lines: DataFrame) -> DataFrame:
    return lines.groupBy("row").agg(F.count_if(F.col("kind") == "exact").alias("n_exact"), F.count_if(F.col("kind") == "near").alias("n_near"),
                                    F.sort_array(F.collect_set("line")).alias("dropped"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edits: int = 1) -> DataFrame:
    """(id, n_exact, n_near, dropped) for each row; dropped: the dropped line numbers as sorted array."""
    keyed, row, lines = _found(docs, id_col, text_col, min_words, edits)
    ids = keyed.select(F.col(row).alias("row"), F.col(id_col).cast("bigint").alias("id"))
    out = ids.join(_per_row(lines), "row", "left")
    return out.select(F.col("id").alias(id_col), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_exact", "n_near")),
                      F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edits: int = 1) -> DataFrame:
    """``docs`` with the duplicate lines taken out of their texts."""
    keyed, row, lines = _found(docs, id_col, text_col, min_words, edits)
    whole = keyed.select(F.col(row).alias("row"), F.struct(*docs.columns).alias("doc"))
    whole = whole.join(_per_row(lines).select("row", "dropped").hint("merge"), "row", "left")
    text = F.col("doc").getField(text_col)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("dropped", i)), "\n")
    text = F.when(F.size("dropped") > 0, kept).otherwise(text)
    return whole.select(*[(text if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns])
