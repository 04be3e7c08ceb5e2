"""Operator 6: language ID by interpolated Kneser-Ney character models.

A text is its letters in lower case, with each run of anything else as one blank. Every language has a model of
characters given the three before; counts come from a sample of labelled texts of bounded size. The models of all
languages share sorted arrays of n-gram keys (16 bits a character, so a 4-gram is one 64-bit key), each key with one
log-probability for each language; keys that no array holds back off to shorter ones by the context's weight.
The language with the lowest cross-entropy per character wins. Held-back labelled texts set the scale that turns
cross-entropies into the winner's probability, and the cross-entropy beyond which a text is rejected.

Defined results: null text or text without a letter: ``und``, score 0, rejected. Null languages and null ids are not
learned from. Without any labelled text all is ``und``. One output row for each input row; an empty table gives an
empty result. Extra columns of any name pass through untouched or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import slices, tidy
from .storage import Scratch, ship

ORDER = 4
FIT_TEXTS = 800        # labelled texts of a language that its model is fitted on, about
CHECK_TEXTS = 200      # further ones that scale and rejection are set on, about
REJECT_MARGIN = 1.0    # nats per character beyond the worst held-back text
REJECT_LETTERS = 30    # shorter texts are never rejected by cross-entropy
_EDGE = "\x01"
_U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(65536)])


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-gram key of each scored character, its text, letters in each text)."""
    joined = "".join(_EDGE * 3 + (t or "").replace(_EDGE, " ").lower() for t in texts)
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = raw & 0xFFFF
    letter = _letters()[low]
    wide = np.flatnonzero(raw > 0xFFFF)
    if len(wide):
        letter[wide] = [chr(c).isalpha() for c in raw[wide]]
    edge = raw == 1
    before = np.concatenate([[False], letter[:-1]])
    keep = letter | edge | before
    code = np.where(letter[keep], np.maximum(low[keep], 1), 0).astype(np.uint64)
    edge = edge[keep]
    text = np.cumsum(edge) // 3 - 1
    key = code.copy()
    for k in range(1, ORDER):
        key[k:] |= code[:-k] << _U(16 * k)
    scored = ~edge
    own = text[scored]
    return key[scored], own, np.bincount(own[code[scored] > 0], minlength=len(texts))


def _low(keys: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` characters of keys."""
    return keys if n == 4 else keys & _U((1 << 16 * n) - 1)


class Model:
    """Log-probabilities of all languages in sorted key arrays, one for each order."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        n = len(self.langs)
        levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER + 1)]
        for lang in self.langs:
            keys, count = counts[lang]
            order = np.argsort(keys)
            keys, count = keys[order], count[order].astype(np.float64)
            levels[ORDER].append((keys, count))
            for k in range(ORDER - 1, 0, -1):  # how many different characters stand before each shorter n-gram
                keys, count = np.unique(_low(keys, k), return_counts=True)
                levels[k].append((keys, count.astype(np.float64)))
        self.keys: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.logp: list[np.ndarray] = [np.zeros((0, n), np.float32)]
        self.contexts: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.weight: list[np.ndarray] = [np.zeros((0, n), np.float32)]
        symbols = len(np.unique(np.concatenate([keys for keys, _ in levels[1]]))) + 1
        self.least = -float(np.log(symbols))
        for k in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([x for x, _ in levels[k]]))
            contexts = np.unique(keys >> _U(16)) if k > 1 else np.zeros(1, np.uint64)
            lower = np.exp(self._look(k - 1, _low(keys, k - 1))) if k > 1 else np.full((len(keys), n), 1 / symbols)
            prob, weight = np.zeros((len(keys), n)), np.ones((len(contexts), n))
            where = np.searchsorted(contexts, keys >> _U(16)) if k > 1 else np.zeros(len(keys), np.int64)
            for j, (own, count) in enumerate(levels[k]):
                ones, twos = (count == 1).sum(), (count == 2).sum()
                off = ones / (ones + 2 * twos) if ones and twos else 0.5
                at = np.searchsorted(contexts, own >> _U(16)) if k > 1 else np.zeros(len(own), np.int64)
                total = np.bincount(at, weights=count, minlength=len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                seen = total > 0
                weight[seen, j] = np.clip(off * kinds[seen] / total[seen], 1e-6, 1)
                prob[np.searchsorted(keys, own), j] = (count - off) / total[at]
            prob += weight[where] * lower
            self.keys.append(keys)
            self.logp.append(np.log(np.maximum(prob, 1e-12)).astype(np.float32))
            self.contexts.append(contexts)
            self.weight.append(np.log(weight).astype(np.float32))

    def _look(self, k: int, keys: np.ndarray) -> np.ndarray:
        if k == 0:
            return np.full((len(keys), len(self.langs)), self.least, dtype=np.float32)
        at = np.minimum(np.searchsorted(self.keys[k], keys), len(self.keys[k]) - 1)
        out = self.logp[k][at]
        missing = np.flatnonzero(self.keys[k][at] != keys)
        if len(missing):
            less = self._look(k - 1, _low(keys[missing], k - 1))
            if k > 1:
                context = keys[missing] >> _U(16)
                c = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
                known = (self.contexts[k][c] == context)[:, None]
                less = less + np.where(known, self.weight[k][c], np.float32(0))
            else:
                less = less + self.weight[1][0]
            out[missing] = less
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy of each text under each language, letters of each text)."""
        key, own, letters = codes(texts)
        logp = self._look(ORDER, key)
        length = np.maximum(np.bincount(own, minlength=len(texts)), 1)
        sums = np.stack([np.bincount(own, weights=logp[:, j], minlength=len(texts)) for j in range(len(self.langs))], axis=1)
        return -sums / length[:, None], letters


def _parts(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` characters of column 0."""
    for part in slices(batch, 256):
        size = np.cumsum(pa.compute.fill_null(pa.compute.utf8_length(part.column(0)), 0).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(size // most)) + 1), part.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.compute  # noqa: F401

    for batch in batches:
        for part in _parts(batch):
            key, own, _ = codes(part.column(0).to_pylist())
            langs = np.array(part.column(1).to_pylist(), dtype=object)[own]
            for lang in set(part.column(1).to_pylist()):
                keys, count = np.unique(key[langs == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(count)], ["lang", "key", "n"])


def _entropy_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for part in _parts(batch):
                h, letters = model.value.entropies(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(list(h), pa.list_(pa.float64())), pa.array(letters)], ["lang", "h", "letters"])
    return run


class Identifier:
    """Models of the languages of labelled texts, with the scale of scores and the bound of rejection."""

    def __init__(self, labelled: DataFrame, text_col: str, lang_col: str, id_col: str):
        spark = labelled.sparkSession
        ship(spark)
        known = labelled.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
            F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).alias("draw"))
        sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        self.model, self.scale, self.bound = None, 1.0, float("inf")
        if not sizes:
            return
        share = F.lit(0.0)
        for lang, n in sizes.items():
            share = F.when(F.col("lang") == lang, min(1.0, (FIT_TEXTS + CHECK_TEXTS) / n)).otherwise(share)
        scratch = Scratch(spark, "langid")
        drawn = scratch.write(known.filter(F.col("draw") < share * (1 << 30)).select("text", "lang", (F.col("draw") % (FIT_TEXTS + CHECK_TEXTS) < FIT_TEXTS).alias("fit")), "sample")
        rows = drawn.filter("fit").select("text", "lang").mapInArrow(tidy(_count), "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
        found = rows.toArrow()
        langs, keys, counts = np.array(found["lang"].to_pylist(), dtype=object), found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
        if not len(keys):
            return
        model = Model({lang: (keys[langs == lang], counts[langs == lang]) for lang in set(langs)})
        self.model = spark.sparkContext.broadcast(model)  # its size is bounded by the sample's
        held = drawn.filter("NOT fit").select("text", "lang").mapInArrow(tidy(_entropy_rows(self.model)), "lang string, h array<double>, letters bigint").collect()
        held = [(model.langs.index(r["lang"]), np.array(r["h"]), r["letters"]) for r in held if r["letters"] and r["lang"] in model.langs]
        if held:
            gold, h = np.array([x[0] for x in held]), np.stack([x[1] for x in held])
            loss = {s: -np.mean(_log_share(h, s)[np.arange(len(gold)), gold]) for s in (1, 2, 5, 10, 20, 50, 100)}
            self.scale = float(min(loss, key=loss.get))
            long = [x[1].min() for x in held if x[2] >= REJECT_LETTERS]
            self.bound = max(long, default=float("inf")) + REJECT_MARGIN

    def predict(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` as a column ``row`` (struct), with lang_pred, score, cross_entropy and rejected."""
        rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        if self.model is None:
            return rows.select("row", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
        shared, scale, bound = self.model, self.scale, self.bound

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.compute  # noqa: F401

            model = shared.value
            for batch in batches:
                for part in _parts(batch):
                    h, letters = model.entropies(part.column(0).to_pylist())
                    best = h.argmin(axis=1)
                    some, at = letters > 0, np.arange(len(best))
                    share = np.exp(_log_share(h, scale)[at, best])
                    lang = [model.langs[b] if s else "und" for b, s in zip(best, some)]
                    entropy = h[at, best]
                    out = ~some | (letters >= REJECT_LETTERS) & (entropy > bound)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1), pa.array(lang, pa.string()), pa.array(np.where(some, np.clip(share, 0, 1), 0.0)),
                         pa.array(entropy, mask=~some), pa.array(out)], ["row", "lang_pred", "score", "cross_entropy", "rejected"])

        kind = _ddl(docs)
        return rows.mapInArrow(tidy(run), f"row struct<{kind}>, lang_pred string, score double, cross_entropy double, rejected boolean")


def _ddl(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.schema.fields)


def _log_share(h: np.ndarray, scale: float) -> np.ndarray:
    x = -scale * h
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, cross_entropy, rejected); learned from the rows that are not held out."""
    found = Identifier(docs.filter(~held_out(id_col)), text_col, lang_col, id_col)
    out = found.predict(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", "text"), "text")
    return out.select(F.col("row.id").alias(id_col), held_out("row.id").alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged."""
    found = Identifier(docs.filter(~held_out(id_col)), text_col, lang_col, id_col)
    return found.predict(docs, text_col).filter("NOT rejected").select("row.*")
