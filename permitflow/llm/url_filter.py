"""Operator 10: URL filter: rules, then host word segmentation with a multinomial naive Bayes model.

Rules (host suffix, path prefix) decide where one fits; the longest wins. All other URLs are judged by their words:
names run together in hosts ("cheapflights") are split by a unigram Viterbi search, whose word counts come from the
text of all pages, and the words of host and path are scored by naive Bayes. That model learns from the URLs that the
rules decide. Counts are taken over all pages, and all words count: both tables are written and joined, by the pieces of
distinct names and by the words of distinct names. Only words of up to three letters, of which the alphabet allows
18,278, are sent to all tasks.

Both verdicts have the same prior: what share of the decided URLs the rules block depends on the rules, not on the URLs
that they leave. A URL is blocked only if its words are likelier among blocked URLs than among allowed ones.

Defined results: a null URL, or one without ``://``: host and path empty, no words, allowed. Null and
repeated ids pass through, one output row for each input row. Without any decided URL the verdict is allow. An empty
table gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import slices
from .storage import Scratch

# fixed values: the contract's rules (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
LONGEST_WORD = 20
SHORT_WORD = 3         # words of up to so many letters (26 + 26**2 + 26**3 at most) are sent to all tasks, longer ones are joined
_HELD = 200_000        # words a task counts or cuts before it sends them on
_STARTS = 10_000       # letters of a name whose pieces are made together
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct(rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later ones stand before earlier ones
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _page_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the words of pages, outside tags, scripts and styles."""
    markup = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
    word = re.compile(r"(?<![^\W\d_])[a-z]{1,%d}(?![^\W\d_])" % LONGEST_WORD)
    counts: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for html in batch.column(0).to_pylist():
            counts.update(word.findall(markup.sub(" ", html or "").lower()))
            if len(counts) > _HELD:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


class Segmenter:
    """Splits names into the likeliest words by unigram counts."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = total or sum(counts.values()) or 1
        self.cost = self.costs(counts)
        self.unknown = [math.log(self.total) + 1 + k * math.log(10) for k in range(LONGEST_WORD + 1)]

    def costs(self, counts: dict[str, int]) -> dict[str, float]:
        return {w: -math.log(n / self.total) for w, n in counts.items()}

    def split(self, name: str, counts: dict[str, int] | None = None) -> list[str]:
        """The name's words; ``counts`` has words that the segmenter was not made with."""
        more = self.costs(counts or {})
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            costs = []
            for start in range(max(0, end - LONGEST_WORD), end):
                word = name[start:end]
                cost = self.cost.get(word)
                if cost is None:
                    cost = more.get(word, self.unknown[end - start])
                costs.append((best[start] + cost, start))
            cost, start = min(costs)
            best.append(cost)
            back.append(start)
        found, end = [], len(name)
        while end:
            found.append(name[back[end]:end])
            end = back[end]
        found.reverse()
        return found


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the names in host and path, marked h: or p:; numbers are #."""
    token = re.compile(r"[^\W\d_]+|\d+")
    for batch in batches:
        found = [[f"{kind}:#" if t[0].isdigit() else f"{kind}:{t}" for kind, text in (("h", h or ""), ("p", (p or "").lower())) for t in token.findall(text)]
                 for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.string()))], [*batch.schema.names, "tokens"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name_id, word): what may be a word in each name, besides short words. A long name's pieces may come more than once."""
    run = re.compile(r"[a-z]+")
    ids, words = [], []

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], ["name_id", "word"])

    for batch in batches:
        for i, name in zip(batch.column("name_id").to_pylist(), batch.column("name").to_pylist()):
            for r in run.findall(name):
                for first in range(0, len(r), _STARTS):
                    last = min(first + _STARTS, len(r))
                    found = {r[a:a + k] for k in range(SHORT_WORD + 1, LONGEST_WORD + 1) for a in range(first, min(last, len(r) - k + 1))}
                    ids += [i] * len(found)
                    words += found
                    if len(words) > _HELD:
                        yield rows()
                        ids, words = [], []
    yield rows()


def _segments(scratch: Scratch, unigrams: DataFrame, names: DataFrame) -> DataFrame:
    """(name, words) for each row of ``names`` (distinct); unigrams is a written table (word, n)."""
    total = unigrams.agg(F.sum("n")).first()[0] or 1
    short = {r["word"]: r["n"] for r in unigrams.filter(F.length("word") <= SHORT_WORD).collect()}  # 18,278 at most
    long = unigrams.filter(F.length("word") > SHORT_WORD)
    names = scratch.write(names.select(F.monotonically_increasing_id().alias("name_id"), "name"), "distinct")
    known = names.mapInArrow(_pieces, "name_id bigint, word string").join(long, "word").select("name_id", F.struct("word", "n").alias("known"))
    per = names.join(known.groupBy("name_id").agg(F.collect_set("known").alias("known")), "name_id", "left").select("name", "known")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(short, total)
        for batch in batches:
            for part in slices(batch):
                words = [segmenter.split(name, {k["word"]: k["n"] for k in known or ()})
                         for name, known in zip(part.column("name").to_pylist(), part.column("known").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("name"), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return scratch.write(per.mapInArrow(split, "name string, words array<string>"), "segments")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", teach: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, words, block_log_odds) for each row.

    ``teach``: a condition on the columns of ``pages``; the model learns only from decided URLs that meet it, so that
    ``block_log_odds`` of the others can be held against their rules.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "url")
    counted = (pages.select(F.col(text_col).alias("html")).mapInArrow(_page_words, "word string, n bigint")
               .groupBy("word").agg(F.sum("n").alias("n")))
    unigrams = scratch.write(counted, "unigrams")

    teach = F.lit(True) if teach is None else F.coalesce(teach, F.lit(False))
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), teach.alias("teach"))
    host, path = host_and_path(F.col("url"))
    source = source.select("id", "teach", host.alias("host"), path.alias("path"))
    source = source.select("id", "teach", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found"))
    source = source.select(F.monotonically_increasing_id().alias("row"), "id", "host", "path", "found.rule", "found.verdict", "teach")
    kind = source.schema["id"].dataType.simpleString()
    schema = f"row bigint, id {kind}, host string, path string, rule string, verdict string, teach boolean"
    urls = scratch.write(source.mapInArrow(_tokens, schema + ", tokens array<string>"), "urls")

    # distinct names with the decided URLs' uses of them, their words, and the words' weights
    taught, block = F.col("rule").isNotNull() & F.col("teach"), F.col("verdict") == "block"
    tokens = scratch.write(urls.select(F.explode("tokens").alias("token"), "rule", "verdict", "teach").groupBy("token").agg(
        F.count_if(taught & block).alias("block"), F.count_if(taught & ~block).alias("allow")), "tokens")
    tokens = tokens.withColumn("name", F.expr("substr(token, 3)"))
    segments = _segments(scratch, unigrams, tokens.filter("name <> '#'").select("name").distinct())
    words = F.transform(F.coalesce("words", F.array("name")), lambda w: F.concat(F.substring("token", 1, 2), w))
    tokens = scratch.write(tokens.join(segments, "name", "left").select(
        F.monotonically_increasing_id().alias("token_id"), "token", "block", "allow", words.alias("words")), "names")
    per_word = tokens.filter("block + allow > 0").select(F.explode("words").alias("word"), "block", "allow")
    per_word = scratch.write(per_word.groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "words")
    sums = per_word.agg(F.count("*").alias("words"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("block", "allow"))).first()
    totals = [sums[c] + sums["words"] + 1 for c in ("block", "allow")]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = zip(batch.column("block").to_pylist(), batch.column("allow").to_pylist())
            weight = [math.log((b + 1) / totals[0]) - math.log((a + 1) / totals[1]) for b, a in counts]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(weight, pa.float64())], ["word", "weight"])

    weights = per_word.mapInArrow(weighed, "word string, weight double")
    each = tokens.select("token_id", F.posexplode("words").alias("at", "word")).join(weights, "word", "left")
    per = each.groupBy("token_id").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("weight", F.lit(0.0)).alias("weight")))).alias("weights"))
    names = scratch.write(tokens.join(per, "token_id").select("token", "words", F.col("weights.weight").alias("weights")), "weights")

    # back to the rows; the hot names' side of the join is dealt anew by the skew join
    of_row = (urls.select("row", F.posexplode("tokens").alias("at", "token")).join(names, "token")
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "words", "weights"))).alias("names"))
              .select("row", F.flatten("names.words").alias("words"), F.flatten("names.weights").alias("weights")))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = [sum(weights or ()) for weights in batch.column("weights").to_pylist()]
            verdict = [v or ("block" if o > 0 else "allow") for v, o in zip(batch.column("verdict").to_pylist(), odds)]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "weights"} | {"verdict": pa.array(verdict, pa.string()), "block_log_odds": pa.array(odds, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    none = F.array().cast("array<string>")
    joined = urls.drop("tokens", "teach").join(of_row, "row", "left").select(
        "id", "host", "path", "rule", "verdict", F.coalesce("words", none).alias("words"), "weights")
    return joined.mapInArrow(scored, f"id {kind}, host string, path string, rule string, verdict string, words array<string>, block_log_odds double"
                             ).withColumnRenamed("id", id_col)
