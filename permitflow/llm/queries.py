"""Registered queries: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import public_tokenizers

from . import oracle
from .bpe import token_counts
from .decontaminate import report
from .exact_dedup import exact_groups
from .expressions import let
from .jaccard import jaccard_components
from .langid import identify
from .line_dedup import line_report
from .packing import pack
from .pii import span_report
from .registry import ORACLE, QUERIES, register, table
from .runs import periodic_runs
from .storage import Scratch
from .tiktokens import decode, encode
from .trie import TURN_BYTES, conversation_keys, prefix_trie
from .url_filter import judge
from .warc import archive_pages

__all__ = ["ORACLE", "QUERIES"]


@register("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


@register("op2_exact_dedup", oracle.EXACT_DEDUP)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@register("op3_warc", oracle.WARC)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"), least_bytes=0)
    return records.select(records["row_id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op4_ngram_jaccard", oracle.NGRAM_JACCARD)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@register("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


@register("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(table(spark, sf_dir, "documents"))


@register("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the contract's texts: of every tenth document the words from a on repeat with period p
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(F.struct(w.alias("w"), a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(
            x["w"], lambda word, i: F.when(i < x["a"], word).otherwise(F.get(x["w"], (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " "))

    text = F.when(h % 10 == 0, let(words, repeated)).otherwise(F.col("text"))
    found = periodic_runs(docs.select("doc_id", text.alias("text")))
    # runs come by start, then period: a later one is best only if its exponent is greater
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


@register("op12_prefix_trie", oracle.PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Scratch(spark, "rebuilt").write(conversation_keys(table(spark, sf_dir, "conversations")), "own")
    # the contract's conversations: the first h turns come from the first conversation of the hundred
    heads = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.expr(f"substring(key, 1, {5 * TURN_BYTES})").alias("head"))
    rows = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % 6 * TURN_BYTES).cast("int")).withColumn("base", F.expr("conv_id - conv_id % 100"))
    key = F.expr("concat(coalesce(substring(head, 1, h), X''), substring(key, h + 1))")
    return prefix_trie(rows.join(heads, "base", "left").select("conv_id", key.alias("key")))


@register("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = decode(encode(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
