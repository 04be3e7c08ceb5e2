"""Operator 7: benchmark decontamination by template windows, in DataFrame functions only.

A text becomes a row of tokens: literal words in lower case, without punctuation, and typed slots for numbers, names
(capitalised words inside a sentence) and units (after a number). Its template has the slots' types without their
values, so a question with other numbers or names has the same template. Windows of ``width`` successive template
tokens of documents are hash-joined with those of the benchmark. A window counts if its slots are consistent: the
same benchmark value is the same document value throughout, and different ones differ. (Two rows of values are a
consistent renaming of each other exactly when each value first occurs at the same place in both.)

The same windows are also joined literally: the tokens in lower case, without slots. So an exact copy counts whatever its
letter case and however many numbers it holds, and so does one whose first word stands inside a sentence. At least half
of a template window's tokens are literal; in one of 8 tokens or more whose slots are numbers and units only, two
literal ones do ("What is 3 + 4 + 5 ..." with other numbers). Other windows say nothing by their template and
count by their literal tokens only.

Items of fewer than ``width`` tokens are one window of their own length; all lengths are looked for in one scan of the texts. In scripts that are written without blanks
(Chinese, Japanese, Thai, Lao, Khmer, Burmese) every letter is a token.

Defined results: null or empty texts and items match nothing; items of fewer than ``least`` tokens take no part.
Results are per document id: repeated ids share one result row each, null ids are joined null-safely. An empty table
on either side gives no match. Extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .expressions import let
from .storage import Scratch

WIDTH = 13
LEAST = 5
NUMERIC = 8   # template windows of at least so many tokens may be mostly numbers,
LITERALS = 2  # if so many of their tokens are literal
ANCHORS = 20_000  # benchmark half-window keys of a length that texts are first looked through for; with more, all texts make windows
SLOT = "\u0001"
# fixed values: scripts without blanks between words, and units
BLANKLESS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&\p{L}]"
UNITS = ("mm cm dm m km mg g kg t ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks "
         "month months year years inch inches ft foot feet yard yards mile miles lb lbs oz pound pounds dollar dollars euro euros "
         "cent cents percent degree degrees volt volts watt watts meter meters metre metres gram grams liter liters litre litres").split()


def marked(text: Column) -> Column:
    """The text's tokens, parted by one blank each; a slot is its mark, its type (n, a, u) and its value."""
    t = F.translate(F.coalesce(text, F.lit("")), SLOT, " ")
    # each pattern begins with the class that most characters fail
    t = F.regexp_replace(t, r"\p{Lu}(?<=[\p{L}\p{N},;] \p{Lu})\p{Ll}+(?![\p{L}\p{N}])", SLOT + "a$0")
    t = F.regexp_replace(F.lower(t), BLANKLESS, " $0 ")
    t = F.regexp_replace(t, r"\p{N}(?<![\p{L}\p{N}]\p{N})\p{N}*+(?:[.,]\p{N}++)*+", SLOT + "n$0")
    t = F.trim(F.regexp_replace(t, r"(?:[^\p{L}\p{N}" + SLOT + r".,]|[.,](?!\p{N})|[.,](?<!\p{N}[.,]))++", " "))
    return let(t, lambda m: F.when(F.contains(m, F.lit(SLOT + "n")), F.regexp_replace(
        m, "(" + SLOT + "n[^ ]++) (" + "|".join(UNITS) + ")(?= |$)", "$1 " + SLOT + "u$2")).otherwise(m))


def template(tokens: Column) -> Column:
    """Marked text with the slots' values taken out."""
    return F.when(F.contains(tokens, F.lit(SLOT)), F.regexp_replace(tokens, "(" + SLOT + "[nau])[^ ]*+", "$1")).otherwise(tokens)


def _tokens(m: Column) -> Column:
    """Whether marked text has slots, its tokens, and the hashes of its template's tokens and of its literal ones (if they differ)."""
    hashes = lambda t: F.transform(F.split(t, " "), lambda w: F.xxhash64(w))
    slots = F.contains(m, F.lit(SLOT))
    return F.struct(slots.alias("any"), F.split(m, " ").alias("raw"), hashes(template(m)).alias("hashes"),
                    F.when(slots, hashes(F.regexp_replace(m, SLOT + "[nau]", ""))).alias("words"))


def _runs(hashes: Column, start: int, length, step: int = 1) -> Column:
    """Keys of the runs of ``length`` tokens from every ``step``-th place; empty for shorter texts."""
    places = F.sequence(F.lit(start), F.greatest(F.size(hashes) - length + 1, F.lit(start)), F.lit(step))
    return F.when(F.size(hashes) >= length, F.transform(places, lambda i: F.xxhash64(F.slice(hashes, i, length)))).otherwise(F.array().cast("array<bigint>"))


def _both_runs(t: Column, start: int, length, step: int = 1) -> Column:
    """Keys of the runs of a text's template, and of its literal tokens if they differ."""
    runs = _runs(t["hashes"], start, length, step)
    return F.when(t["any"], F.concat(runs, _runs(t["words"], start, length, step))).otherwise(runs)


def _windows(t: Column, width) -> Column:
    """(width, at, key, slots) of all windows of ``width`` tokens: template windows with their slot tokens, and for those that
    have slots also the literal window, whose slots are empty. (A window without slots is its own literal window.)
    The text must have ``width`` tokens."""
    none, wide = F.array().cast("array<string>"), width if isinstance(width, Column) else F.lit(width)

    def window(i: Column) -> Column:
        one = lambda hashes, slots: F.struct(wide.alias("width"), i.alias("at"), F.xxhash64(F.slice(hashes, i, width)).alias("key"), slots.alias("slots"))
        slots = F.filter(F.slice(t["raw"], i, width), lambda w: w.startswith(SLOT))
        return F.when(t["any"], let(slots, lambda s: F.when(F.size(s) > 0, F.array(one(t["hashes"], s), one(t["words"], none)))
                                    .otherwise(F.array(one(t["hashes"], none))))).otherwise(F.array(one(t["hashes"], none)))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(t["raw"]) - width + 1), window))


def _wanted(t: Column, width: int, anchors: list[int] | None) -> Column:
    """Whether a text can share a window of ``width`` tokens with the benchmark.

    ``anchors`` are the keys of all runs of half a window (rounded up) in the benchmark. The text shows its own such runs from
    every half window: a shared window always covers one of them. Without anchors, every text that is long enough can.
    """
    enough, half = F.size(t["raw"]) >= width, (width + 1) // 2
    if anchors is None:
        return enough
    return enough & F.arrays_overlap(_both_runs(t, 1, half, width - half + 1), F.from_json(F.lit(str(anchors)), "array<bigint>"))


def _renaming(slots: Column) -> Column:
    """Where each slot's value first occurs: equal for two rows that rename each other."""
    return F.transform(slots, lambda s: F.array_position(slots, s))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """(id, items, windows) for each document with a benchmark window: its item ids and how many windows match."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col(item_col).alias("item"), let(marked(F.col(item_text_col)), lambda m: F.when(m != "", _tokens(m))).alias("t"))
    items = scratch.write(items.filter(F.size("t.raw") >= least).withColumn("width", F.least(F.size("t.raw"), F.lit(width))), "items")
    t, size, slots = F.col("t"), F.col("width"), F.size("slots")
    own = items.select("item", F.inline(_windows(t, size)))
    numeric = (size >= NUMERIC) & (size - slots >= LITERALS) & ~F.exists("slots", lambda s: s.startswith(SLOT + "a"))
    own = own.filter((slots * 2 <= size) | numeric).select("item", "width", "key", F.col("slots").alias("item_slots")).distinct()
    own = scratch.write(own, "windows")  # AQE sends it to all tasks if its bytes allow
    anchors = items.select("width", F.explode(_both_runs(t, 1, ((size + 1) / 2).cast("int"))).alias("anchor")).distinct()
    counts = dict(anchors.groupBy("width").count().collect())  # a row for each length up to ``width``
    known = {w: None if n > ANCHORS else [] for w, n in counts.items()}
    for w, anchor in anchors.filter(F.col("width").isin([w for w, a in known.items() if a is not None])).collect():
        known[w].append(anchor)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if known:
        def windows(t: Column) -> Column:
            parts = F.array(*[F.when(_wanted(t, w, a), _windows(t, w)) for w, a in sorted(known.items())])
            return F.flatten(F.filter(parts, lambda p: p.isNotNull()))
        found = texts.select("id", let(marked(F.col("text")), lambda m: let(_tokens(m), windows)).alias("windows")).select("id", F.inline("windows"))
        found = found.join(own, ["width", "key"]).filter(_renaming(F.col("slots")) == _renaming(F.col("item_slots")))
        hits = found.select("id", "item", "width", "at")
    else:
        hits = texts.select("id", F.lit(None).cast(benchmark.schema[item_col].dataType).alias("item"), F.lit(0).alias("width"), F.lit(0).alias("at")).filter("false")
    per = hits.groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"), F.count_distinct("width", "at").alias("windows"))
    return scratch.write(per, "hits").withColumnRenamed("id", id_col)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, contaminated, n_windows, items) for each document id."""
    hits = contaminated(docs, benchmark, id_col=id_col, **options).withColumnRenamed(id_col, "_id")
    ids = docs.select(F.col(id_col)).distinct()
    none = F.array().cast(hits.schema["items"].dataType)
    return ids.join(hits, ids[id_col].eqNullSafe(hits["_id"]), "left").select(
        id_col, F.col("items").isNotNull().alias("contaminated"), F.coalesce("windows", F.lit(0)).cast("bigint").alias("n_windows"),
        F.coalesce("items", none).alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, unchanged; each row is judged by its own text, whatever the ids are."""
    keyed, row = Scratch(docs.sparkSession, "clean").keyed(docs)
    hits = contaminated(keyed, benchmark, id_col=row, **options).select(row)
    return keyed.join(hits, row, "left_anti").drop(row)
