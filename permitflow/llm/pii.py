"""Operator 9: personal data by weak supervision, in DataFrame functions only.

Base spans are what the contract's patterns and checks give; they always stay. The method adds spans: candidates are
the matches that a check turned down, and matches of looser patterns (national phone numbers, spelt-out mail
addresses, and values that look like passwords, tokens or access keys: kind ``secret``, which has no base spans). Labelers
of three kinds vote on every candidate, or abstain: regex (the strict pattern and its check), gazetteer (top-level
domains, dialling codes, card issuers, special networks, key prefixes) and context (words before the span, and
what touches it). Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability, and
with it a probability for each pattern; a logistic classifier of the final spans is trained on these as soft labels.
It sees more than the votes: how many groups of digits a span has, what parts them, whether letters and digits mix.
Patterns of votes and shapes are few (their number does not depend on the data), so models are fitted on their counts.

Matching is linear in a text's length: patterns start at the edges of their runs and repeat possessively, so they
neither back-track nor recurse. A match's place comes from the lengths of what ``split`` leaves between matches.

Defined results: null text counts as empty: no spans. Null and repeated ids pass through, one output row for each input
row. An empty table gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from .expressions import let
from .storage import Scratch

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
_LOCAL = r"[A-Za-z0-9._%+-]"
# fixed values: the contract's patterns, written so that they cannot back-track
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(]?\x20?\bat\b\x20?[\])]?\x20[A-Za-z0-9-]{{1,64}}+\x20?[\[(]?\x20?\bdot\b\x20?[\])]?\x20(?:com|net|org|edu|io)\b",
    "phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16,128}+(?![A-Za-z0-9_])",
}
# a text without a match of these has no match of the pattern
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]",
         "email_loose": r"(?i)\bdot\b", "phone_loose": r"[0-9]{3}[\x20.-][0-9]{4}",
         "secret_loose": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16}"}
# fixed values: gazetteers and context words
DOMAINS = "com net org edu gov io info biz de fr es it uk us eu ch at nl be pl ru jp cn in br ca au".split()
DIALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 64 65 81 82 86 90 91".split()
ISSUERS = "4 51 52 53 54 55 22 23 24 25 26 27 34 37 36 38 30 6011 65 35 62 50 56 57 58 63 67".split()
CUES = {"email": "mail write contact address", "ip": "ip addr server host client from network", "card": "card visa master credit debit pay account",
        "phone": "phone tel call fax mobile cell dial ring sms", "secret": "password passwd pwd token secret key credential login auth"}
PREFIXES = "AKIA ASIA ghp_ gho_ xoxb xoxp sk_live rk_live eyJ"  # fixed values: beginnings of access keys
AGAINST = "version isbn issn order serial token sha hash key invoice article section item"
ADDED = 0.9  # the least probability of a span that the method adds
_DIGITS = r"[^0-9]"


def _matches(text: Column, pattern: str, kind: str, loose: bool) -> Column:
    """array<struct<kind, loose, gap, value, before, after>> of a text's matches; null if it has none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    one = let(F.split(text, pattern, -1), lambda gaps: F.transform(found, lambda m, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(loose).alias("loose"), i.alias("place"), F.length(F.get(gaps, i)).cast("bigint").alias("gap"),
        m.alias("value"), F.lower(F.right(F.get(gaps, i), F.lit(40))).alias("before"), F.substring(F.get(gaps, i + 1), 1, 1).alias("after"))))
    hint = _HINT[kind + "_loose" * loose]
    return F.when(F.contains(text, F.lit(hint)) if hint == "@" else F.rlike(text, F.lit(hint)), one)


def _luhn(digits: Column) -> Column:
    """Whether the digits' check sum is right; digits from the right, every second doubled."""
    places = F.sequence(F.lit(1), F.length(digits))
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    term = lambda i: F.when(i % 2 == 0, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)).otherwise(value(i))
    return F.aggregate(places, F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def _strict(kind: Column, value: Column) -> Column:
    """The contract's checks of a match."""
    digits = F.regexp_replace(value, _DIGITS, "")
    n = F.length(digits)
    part = r"(?=[0-9])0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9][0-9]?)?"  # zeros only is 0
    return (F.when(kind == "email", True).when(kind == "secret", False)
            .when(kind == "ip", F.rlike(value, F.lit(rf"^{part}(?:\.{part}){{3}}$")))
            .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _words(words: str) -> str:
    return rf"\b(?:{'|'.join(words.split())})"


def _votes() -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 yes, 0 no, 2 abstains."""
    kind, value, before = F.col("kind"), F.col("value"), F.col("before")
    digits = F.regexp_replace(value, _DIGITS, "")
    yes = lambda c: F.when(c, 1).otherwise(0)
    gazetteer = (F.when(kind == "email", yes(F.lower(F.regexp_extract(value, r"[A-Za-z0-9-]+$", 0)).isin(DOMAINS)))
                 .when(kind == "ip", F.when(~F.col("strict") | F.rlike(value, F.lit(r"^(?:0|127|22[4-9]|2[3-5][0-9])\.")), 0).otherwise(2))
                 .when(kind == "card", yes(F.rlike(digits, F.lit(f"^(?:{'|'.join(ISSUERS)})"))))
                 .when(kind == "secret", F.when(F.rlike(value, F.lit(f"^(?:{'|'.join(PREFIXES.split())})")), 1).otherwise(2))
                 .otherwise(F.when(value.startswith("+"), yes(F.rlike(digits, F.lit(f"^(?:{'|'.join(DIALLING)})")))).otherwise(2)))
    cue = F.lit(False)
    for k in ALL_KINDS:
        cue = cue | ((kind == k) & F.rlike(before, F.lit(_words(CUES[k]))))
    # a secret's name stands right before its value
    named = F.rlike(before, F.lit(rf"(?:{'|'.join(CUES['secret'].split())})[a-z0-9_]*+[\"']?\x20?[=:]\x20?[\"']?$"))
    context = F.when(kind == "secret", F.when(named, 1).when(cue | (gazetteer == 1), 2).otherwise(0)).when(F.rlike(before, F.lit(_words(AGAINST))), 0).when(cue, 1).otherwise(2)
    mixed = F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    touch = F.rlike(F.right(before, F.lit(1)), F.lit(r"[\p{L}\p{N}_]")) | F.rlike(F.col("after"), F.lit(r"[\p{L}\p{N}_]"))
    regex = F.when(kind == "secret", yes(mixed & (named | (gazetteer == 1)))).otherwise(yes(F.col("strict")))
    return {"v_regex": regex, "v_gazetteer": gazetteer, "v_context": context, "v_edge": yes(~touch)}


def _shape(value: Column) -> Column:
    """One of 24 shapes: groups of digits (none, one, up to five and more), and what parts them."""
    groups = F.least(F.size(F.split(F.regexp_replace(F.regexp_replace(value, r"[^0-9]+", " "), r"^ | $", ""), " ")), F.lit(5))
    groups = F.when(F.rlike(value, F.lit("[0-9]")), groups).otherwise(0)
    marks = F.regexp_replace(value, r"[A-Za-z0-9]+", "")
    kind = F.when(marks == "", 0).when(F.rlike(marks, F.lit(r"^\x20+$")), 1).when(F.rlike(marks, F.lit(r"^[.-]+$")), 2).otherwise(3)
    return (groups * 4 + kind).cast("int")


def _reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 100) -> dict[tuple[str, tuple[int, ...]], float]:
    """EM over vote patterns (kind, votes, count): the probability that a candidate is real, by kind and votes.

    Each labeler has, for real and for false candidates, its own chances of each vote; both are smoothed by one vote.
    """
    out = {}
    for kind in {p[0] for p in patterns}:
        own = [(v, n) for k, v, n in patterns if k == kind]
        real = {v: (1 + sum(x == 1 for x in v)) / (2 + sum(x != 2 for x in v)) for v, _ in own}
        for _ in range(rounds):
            mass = [sum(n * (1 - real[v]) for v, n in own), sum(n * real[v] for v, n in own)]
            chance = [[[(1 + sum(n * (real[v] if c else 1 - real[v]) for v, n in own if v[j] == x)) / (3 + mass[c]) for x in range(3)]
                       for j in range(len(own[0][0]))] for c in (0, 1)]
            for v, _ in own:
                log = [math.log(mass[c] + 1) + sum(math.log(chance[c][j][x]) for j, x in enumerate(v)) for c in (0, 1)]
                real[v] = 1 / (1 + math.exp(min(50, log[0] - log[1])))
        out |= {(kind, v): p for v, p in real.items()}
    return out


def _features(kind: str, votes: tuple[int, ...], loose: bool, shape: int) -> list[float]:
    groups, parted = divmod(shape, 4)
    return [1.0, *(float(kind == k) for k in ALL_KINDS), float(loose), *(float(v == x) for v in votes for x in (0, 1)),
            *(float(groups == g) for g in range(6)), *(float(parted == p) for p in range(4)), *(float(kind == k and groups > 1) for k in ALL_KINDS)]


def _classifier(rows: list[tuple[str, tuple[int, ...], bool, int, int]], real: dict, rounds: int = 300) -> list[float]:
    """Weights of a logistic model of the spans' features, by gradient steps on the soft labels, lightly regularised."""
    data = [(_features(k, v, loose, shape), real[k, v], n) for k, v, loose, shape, n in rows]
    total = sum(n for *_, n in data) or 1
    weights = [0.0] * len(_features(KINDS[0], (2,) * 4, False, 0))
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for x, p, n in data:
            gap = (1 / (1 + math.exp(-max(-50, min(50, sum(w * f for w, f in zip(weights, x)))))) - p) * n / total
            slope = [s + gap * f for s, f in zip(slope, x)]
        weights = [w - 1.5 * s for w, s in zip(weights, slope)]
    return weights


def _scores(spark: SparkSession, counted: list) -> DataFrame:
    """(kind, votes, loose, shape, score): the classifier's probability for each feature pattern, as a SQL table."""
    rows = [(r["kind"], (r["v_regex"], r["v_gazetteer"], r["v_context"], r["v_edge"]), r["loose"], r["shape"], r["n"]) for r in counted]
    both: dict = {}
    for k, v, _, _, n in rows:
        both[k, v] = both.get((k, v), 0) + n
    real = _reliabilities([(k, v, n) for (k, v), n in both.items()])
    weights = _classifier(rows, real)
    score = lambda *x: 1 / (1 + math.exp(-max(-50, min(50, sum(w * f for w, f in zip(weights, _features(*x)))))))
    values = [f"('{k}', {v[0]}, {v[1]}, {v[2]}, {v[3]}, {str(loose).lower()}, {shape}, {score(k, v, loose, shape)!r}D)" for k, v, loose, shape, _ in rows]
    values = values or ["('none', 0, 0, 0, 0, false, 0, 0D)"]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(values) + " AS t(kind, v_regex, v_gazetteer, v_context, v_edge, loose, shape, score)")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row with a number of its own (row, id), and the spans (row, kind, rank, start, end, value, base, score)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    found = [_matches(F.col("text"), p, k, False) for k, p in PATTERNS.items()] + [_matches(F.col("text"), p, k, True) for k, p in LOOSE.items()]
    none = F.array().cast("array<struct<kind:string,loose:boolean,place:int,gap:bigint,value:string,before:string,after:string>>")
    rows = scratch.write(source.select(F.monotonically_increasing_id().alias("row"), "id", F.concat(*[F.coalesce(f, none) for f in found]).alias("found")), "matches")
    each = rows.filter(F.size("found") > 0).select("row", F.inline("found"))
    ends = Window.partitionBy("row", "kind", "loose").orderBy("place")
    each = each.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(ends)).withColumn("start", F.col("end") - F.length("value"))
    # runs of digits too short for a card are no candidates
    digits = F.length(F.regexp_replace("value", _DIGITS, ""))
    each = each.filter((F.col("kind") != "card") | digits.between(13, 19))
    each = each.withColumn("strict", ~F.col("loose") & _strict(F.col("kind"), F.col("value")))
    # a word of letters only, or of one letter case without digits, is no candidate for a secret
    each = each.filter((F.col("kind") != "secret") | F.rlike("value", F.lit("[0-9]")))
    each = scratch.write(each.select("row", "kind", "loose", "start", "end", "value", "strict", _shape(F.col("value")).alias("shape"),
                                     *[c.alias(n) for n, c in _votes().items()]), "candidates")
    pattern = ["kind", "v_regex", "v_gazetteer", "v_context", "v_edge", "loose", "shape"]
    counted = each.groupBy(*pattern).agg(F.count("*").alias("n")).collect()  # at most 5 * 3**4 * 2 * 24 rows
    scored = each.join(F.broadcast(_scores(spark, counted)), pattern)
    chosen = scored.filter(F.col("strict") | (F.col("score") > ADDED))
    # an added span gives way to base spans, and to an added one before it, that it overlaps
    near = Window.partitionBy("row", "kind").orderBy("start", F.desc("strict"), "end")
    earlier = F.max(F.when(F.col("strict"), F.col("end"))).over(near.rowsBetween(Window.unboundedPreceding, -1))
    later = F.min(F.when(F.col("strict"), F.col("start"))).over(near.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(earlier, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    chosen = chosen.withColumn("free", free).filter("strict OR free")
    before = F.max("end").over(near.rowsBetween(Window.unboundedPreceding, -1))
    chosen = chosen.withColumn("past", before).filter(F.col("strict") | (F.coalesce("past", F.lit(0)) <= F.col("start")))
    rank = F.array_position(F.array(*map(F.lit, ALL_KINDS)), F.col("kind")).cast("int")
    return rows.select("row", "id"), chosen.select("row", "kind", rank.alias("rank"), "start", "end", "value", F.col("strict").alias("base"), "score")


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_spans) for each row: counts and digest of the
    base spans, all spans of these kinds; how many secrets there are, and how many spans in all."""
    rows, spans = find_spans(docs, id_col, text_col)
    one = F.struct("rank", "start", "end", F.concat_ws(":", "kind", "start", "end").alias("span"))
    joined = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda s: s["span"]), ",")
    base = F.when(F.col("base"), one)
    per = spans.groupBy("row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS], joined(base).alias("base"),
        joined(F.when(F.col("kind") != "secret", one)).alias("spans"), F.count_if(F.col("kind") == "secret").alias("n_secret"), F.count("*").alias("n_spans"))
    return rows.join(per, "row", "left").select(
        F.col("id").alias(id_col), *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_secret", "n_spans")])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with every span replaced by its kind in brackets, from the last span to the first."""
    rows, spans = find_spans(docs.select(F.struct(id_col, text_col).alias("pair"), F.col(text_col)), "pair", text_col)
    per = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind")), asc=False).alias("spans"))
    cut = F.aggregate("spans", F.struct(F.col(f"id.{text_col}").alias("t"), F.lit(2**31 - 1).cast("bigint").alias("at")), lambda a, s: F.when(
        s["end"] <= a["at"], F.struct(F.concat(F.substring(a["t"], F.lit(1), s["start"].cast("int")), F.lit("["), s["kind"], F.lit("]"),
                                               F.substring(a["t"], (s["end"] + 1).cast("int"), F.length(a["t"]))).alias("t"), s["start"].alias("at"))).otherwise(a))
    return rows.join(per, "row", "left").select(F.col(f"id.{id_col}"), F.coalesce(cut["t"], F.col(f"id.{text_col}")).alias(text_col))
