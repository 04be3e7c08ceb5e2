"""Operator 2: exact dedup by distributed most-significant-digit radix partitioning.

Texts are split by successive runs of bytes ("digits"): round r parts each group by its texts' next digit
until a group holds one text or its texts have ended. Two texts of one group have agreed in every byte so
far, so texts that end in one group are equal; no digest of a text takes part. Digits grow from round to
round (32 bytes, then eight times as many), so a text of n bytes is settled within log8(n / 32) + 2 rounds, and
after the first digit almost only true copies go on.

A round counts its groups with a partial aggregate and joins the groups of two or more back to the rows; a
group with a third of all rows is therefore counted map-side and split by the skew join. That join is a sort-merge join
at every size, so the texts move once, and later only those that go on. Each round's rows are written to the scratch
folder; only rows that go on carry the rest of their text.

Defined results: null text counts as empty. Equal texts keep the row with the least id; of several rows with
that id (or with null ids only) one is kept, the first as written. Null ids come after all others. An empty
table gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import Scratch

FIRST_DIGIT = 32
DIGIT_GROWTH = 8


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    text = normalised(F.col(text_col))
    now = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("text_sha256"),
                      F.encode(text, "UTF-8").alias("rest"), F.lit(0).cast("bigint").alias("part"))
    settled, width, step = [], FIRST_DIGIT, 0
    while True:
        digit = F.substring("rest", 1, width)
        ends = F.octet_length("rest") <= width
        split = now.select("id", "text_sha256", "part", digit.alias("digit"), ends.alias("ends"),
                           F.when(~ends, F.expr(f"substring(rest, {width + 1})")).alias("rest"))
        groups = (split.groupBy("part", "digit", "ends").agg(F.count("*").alias("size")).filter("size > 1")
                  .withColumn("next", F.monotonically_increasing_id()))
        groups = scratch.write(groups, f"groups-{step}")
        on = ["part", "digit", "ends"]
        dealt = split.join(groups.hint("merge"), on, "left").select(
            "id", "text_sha256", "ends", F.col("next").alias("part"), "size",
            F.when(F.col("next").isNotNull(), F.col("rest")).alias("rest"), F.monotonically_increasing_id().alias("row"))
        dealt = scratch.write(dealt, f"rows-{step}")
        scratch.drop(f"groups-{step}")
        done = dealt.filter("part IS NULL OR ends")
        settled.append(done.select(F.lit(step).alias("step"), "part", "row", "id", "text_sha256", F.coalesce("size", F.lit(1)).alias("size")))
        now = dealt.filter("part IS NOT NULL AND NOT ends").select("id", "text_sha256", "rest", "part")
        step, width = step + 1, width * DIGIT_GROWTH
        if now.isEmpty():
            break
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    # of equal texts the least id stays; a group of one keeps its row, which takes no part in the shuffle
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    copies = rows.filter("part IS NOT NULL")
    # written, so that the join below reads plain shuffles and a hot group's rows are split
    groups = scratch.write(copies.groupBy("step", "part").agg(first), "first")
    joined = copies.join(groups.hint("merge"), ["step", "part"]).select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("first.row") == F.col("row")).alias("kept"), "text_sha256")
    alone = rows.filter("part IS NULL").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.col("size").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(joined)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is the first of its kind: one row of each text, whatever the ids are."""
    scratch, rounds = Scratch(docs.sparkSession, "copies"), Scratch(docs.sparkSession, "exact")
    keyed, row = scratch.keyed(docs)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias("key")
    kept = exact_groups(keyed.select(key, F.col(text_col).alias("text")), "key", "text", rounds).filter("kept").select(F.col("key.row").alias(row))
    kept = scratch.write(kept, "kept")
    rounds.clear()
    return keyed.join(kept.hint("merge"), row, "left_semi").drop(row)
