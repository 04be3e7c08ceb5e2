"""Operator 1: best-fit packing by large-item matching.

1. Tasks tokenize whole texts and cut them into pieces of at most ``capacity`` tokens; the pieces (numbers only) are
   written once, each with its rank among the pieces of its length in its task.
2. A plan is made from the histogram of piece lengths: at most ``capacity`` rows, whatever the input. Pieces above one
   third of the capacity are matched greedily, the largest with the largest that still fits, so at most two stand in a
   sequence; smaller ones then go, largest first, to the smallest gap that holds them. Equal lengths are planned
   together: the plan is a list of runs "pieces first..first+n of this length go to sequences s.., k in each, from
   this offset", whose number depends on the capacity alone.
3. A piece's rank among all of its length (its task's start plus its rank there) finds its run, and so its place.

Nothing but the histogram reaches the driver and nothing but the plan is sent to tasks.

Defined results: null or empty text has one piece, the end id alone. Rows with null or repeated ids are packed like
any others. An empty table gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .batches import slices, tidy
from .shingles import segment_hashes, utf8_buffer, word_bounds
from .storage import Scratch

KEPT_WORDS = 1_000_000  # words whose ids one task keeps; the table starts anew when it is full
KEPT_IDS = 8_000_000    # ids of these words (32 MB)
KEPT_LENGTH = 40        # characters of the longest form that is kept apart from its words
BATCH_BYTES = 1 << 20   # of texts encoded at once: a worker keeps memory in proportion, idle or not (410 MB at 4 MB, 240 at 1)
ROW_WORDS = 2000        # new words that the tokenizer gets as one text

_U = np.uint64
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
#: Kinds of bytes as the tokenizer parts ASCII words: a run of letters, each digit, a run of marks. Apostrophes (``'s`` is
#: one token), ``<`` (special tokens), control characters and bytes of other letters are left to ``_of``.
_KIND = np.array([_SPACE if c == 32 else _OTHER if c < 33 or c > 126 or chr(c) in "'<" else
                  _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _MARK for c in range(256)], dtype=np.uint8)


class WordIds:
    """Token ids of texts.

    The tokenizer drops white space between words and never joins across it, so a text's ids are those of its
    words in turn; words repeat and are kept. Whole batches of words are looked up at once by 64-bit hashes of their
    bytes, together with their first and last eight bytes. Where two words share a hash and differ in these, the batch is
    encoded without the table; words of up to 16 bytes can thus not be mistaken for one another.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 64, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of the known words, ascending
        self.number = np.zeros(0, np.int32)  # of each of these words, in order of their coming
        self.pooled = 0
        # by number, with room for more: their first and last eight bytes, and place of their ids in the pool
        self.edges = np.zeros((0, 2), np.uint64)
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")
        self.plain: dict[str, bytes] = {}

    @staticmethod
    def _plain(word: str) -> tuple[str, str]:
        """(word as the tokenizer sees it, closing mark): forms of one word then share an entry.

        The tokenizer lower-cases and parts a mark from the letter or digit before it. Both are done first only for
        Latin-1 words: the lower case of other letters may end in a combining mark, which keeps the mark that
        follows. A word that may hold a special token stays.
        """
        tail = ""
        if word.isascii() or max(word) <= "\xff":
            if word[-1] in ".," and len(word) > 1 and word[-2].isalnum():
                word, tail = word[:-1], word[-1]
            if "<|" not in word:
                word = word.lower()
        return word, tail

    def _ids(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word. Words of letters only are one pre-token each: they are encoded in long rows, and
        cut where a token closes a word."""
        out: dict[str, bytes] = {}
        letters = [w for w in words if w.isalpha()]
        for at in range(0, len(letters), ROW_WORDS):
            row = letters[at:at + ROW_WORDS]
            encoded = self.tokenizer.encode_batch_fast([" ".join(row)], add_special_tokens=False)[0]
            ids = np.asarray(encoded.ids, dtype="<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            if len(ends) != len(row):  # a letter that the tokenizer sees otherwise
                break
            data, start = ids.tobytes(), 0
            for w, end in zip(row, ends.tolist()):
                out[w] = data[start:end]
                start = end
        rest = [w for w in words if w not in out]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []):
            out[w] = np.asarray(e.ids, dtype="<u4").tobytes()
        return out

    def _of(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit bytes."""
        forms, plain = [self._plain(w) for w in words], self.plain
        lacking = {f for pair in forms for f in pair if f and f not in plain}
        plain.update(self._ids(list(lacking)) if lacking else {})
        out = [plain[form] + plain[tail] if tail else plain[form] for form, tail in forms]
        for form in lacking:
            if len(form) > KEPT_LENGTH:
                del plain[form]
        return out

    def _fresh(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, ids in a row, ids of each word) of the words raw[start:end], taken in ``order``.

        Plain ASCII words are encoded in long rows and cut by what they hold: as many tokens close in a word as it
        has runs of letters, digits and runs of marks. Others follow, one by one.
        """
        size = ends - starts + 1
        upto = np.concatenate([[0], np.cumsum(size)])
        text = raw[np.minimum(np.arange(upto[-1]) + np.repeat(starts - upto[:-1], size), len(raw) - 1)]
        text[upto[1:] - 1] = 32
        kind = _KIND[text]
        opens = (kind != _SPACE) & ((kind == _DIGIT) | (kind != np.concatenate([[_SPACE], kind[:-1]])))
        closing = np.add.reduceat(opens, upto[:-1], dtype=np.int64)
        plain = ~np.logical_or.reduceat(kind == _OTHER, upto[:-1])
        own = np.flatnonzero(plain)
        line, cuts = text[np.repeat(plain, size)], np.concatenate([[0], np.cumsum(size[own])])
        rows = [line[a:b].tobytes().decode("ascii") for a, b in zip(cuts[:-1:ROW_WORDS], [*cuts[ROW_WORDS:-1:ROW_WORDS], cuts[-1]])]
        found = [np.asarray(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)] if len(own) else []
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        closed = np.flatnonzero(self.closes[ids]) + 1
        if len(closed) != closing[own].sum():  # another tokenizer than the one described above
            own, ids, closed, plain = own[:0], ids[:0], closed[:0], np.zeros(len(plain), dtype=bool)
        n = np.diff(closed[np.cumsum(closing[own]) - 1], prepend=0)
        rest, data = np.flatnonzero(~plain), raw.tobytes()
        more = self._of([data[s:e].decode() for s, e in zip(starts[rest].tolist(), ends[rest].tolist())])
        sizes = np.fromiter(map(len, more), np.int64, len(more)) // 4
        return np.concatenate([own, rest]), np.concatenate([ids, np.frombuffer(b"".join(more), dtype="<u4")]), np.concatenate([n, sizes])

    def _whole(self, text: str | None) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds): those of text i are ids[bounds[i]:bounds[i + 1]]; null texts have none."""
        raw, offsets = utf8_buffer(texts)
        starts, ends, per_text = word_bounds(raw, offsets)
        if len(self.hashes) > KEPT_WORDS or self.pooled > KEPT_IDS:
            self._forget()
        hashes, first, at = np.unique(segment_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        edges = _edges(raw, starts, ends)
        own = edges[first]
        place = np.searchsorted(self.hashes, hashes)
        lacks = np.ones(len(hashes), dtype=bool)
        inside = place < len(self.hashes)
        lacks[inside] = self.hashes[place[inside]] != hashes[inside]
        number = np.zeros(len(hashes), np.int64)
        number[~lacks] = self.number[place[~lacks]]
        if (own[at] != edges).any() or (self.edges[number[~lacks]] != own[~lacks]).any():  # two words share a hash
            found = [self._whole(t) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        new = np.flatnonzero(lacks)
        if len(new):
            order, ids, n = self._fresh(raw, starts[first[new]], ends[first[new]])
            known = len(self.hashes)
            number[new[order]] = np.arange(known, known + len(new))
            self.hashes = np.insert(self.hashes, place[new], hashes[new])
            self.number = np.insert(self.number, place[new], number[new])
            self.edges = _put(self.edges, known, own[new[order]])
            self.starts = _put(self.starts, known, self.pooled + np.cumsum(n) - n)
            self.lengths = _put(self.lengths, known, n)
            self.pool = _put(self.pool, self.pooled, ids)
            self.pooled += int(n.sum())
        n = self.lengths[number][at]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.pool[np.arange(upto[-1]) + np.repeat(self.starts[number][at] - upto[:-1], n)]
        return ids, upto[np.concatenate([[0], np.cumsum(per_text)])]


def _put(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` after its first ``used`` rows; it grows by halves, so rows are seldom copied."""
    if used + len(more) > len(held):
        held = np.concatenate([held[:used], np.empty((len(more) + used // 2, *held.shape[1:]), held.dtype)])
    held[used:used + len(more)] = more
    return held


def _edges(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first and the last eight bytes of each word as two numbers; a shorter word's bytes are followed by zeros."""
    n = np.minimum(ends - starts, 8)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # the eight bytes at every place
    keep = np.concatenate([[_U(0)], _U(2**64 - 1) >> (_U(64) - np.arange(1, 9, dtype=np.uint64) * _U(8))])[n]
    return np.stack([eight[starts] & keep, eight[ends - n] & keep], axis=1)


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, part, rank = WordIds(path), TaskContext.get().partitionId(), Counter()  # a task's own: an idle worker keeps none
        for whole in batches:
            for batch in slices(whole, 1024, BATCH_BYTES):
                ids, bounds = words.encode(batch.column(1))
                rows = []
                for doc, a, b in zip(batch.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                    data = ids[a:b].tobytes() + end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at:at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc, piece, at // 4, n, zlib.crc32(own), part, rank[n]))
                        rank[n] += 1
                names = ["id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                kinds = [batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names)
    return tidy(run)


def plan_runs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces in each sequence, offset) of each run; see the module's text.

    A length's runs are in order of first rank and together take all ranks from 0.
    """
    left = {n: k for n, k in histogram.items() if k > 0}
    taken = Counter()
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, sequences)
    open_gaps: list[int] = []
    sequences = 0

    def put(length: int, first: int, count: int, each: int, gap: int) -> None:
        """``count`` sequences from ``first``, with ``gap`` free, get ``each`` more pieces."""
        runs.append((length, taken[length], first, each, capacity - gap))
        taken[length] += count * each
        rest = gap - each * length
        if rest:
            if rest not in gaps:
                gaps[rest] = []
                bisect.insort(open_gaps, rest)
            gaps[rest].append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        fit = large[:bisect.bisect_right(large, capacity - n)]
        mate = fit[-1] if fit else None
        if mate == n and left[n] == 1:
            mate = fit[-2] if len(fit) > 1 else None
        if mate is None:
            count = left[n]
            put(n, sequences, count, 1, capacity)
        elif mate == n:
            count = left[n] // 2
            put(n, sequences, count, 2, capacity)
            left[n] -= count  # the other half goes below
        else:
            count = min(left[n], left[mate])
            runs.append((n, taken[n], sequences, 1, 0))
            taken[n] += count
            put(mate, sequences, count, 1, capacity - n)
            left[mate] -= count
            if not left[mate]:
                large.remove(mate)
        sequences += count
        left[n] -= count
        if not left[n]:
            large.remove(n)

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):  # new sequences
                each = capacity // n
                whole = count // each
                if whole:
                    put(n, sequences, whole, each, capacity)
                    sequences += whole
                    count -= whole * each
                if count:
                    put(n, sequences, 1, count, capacity)
                    sequences += 1
                break
            gap = open_gaps[at]
            first, free = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], open_gaps[at]
            each = gap // n
            whole = min(free, count // each)
            if whole:
                put(n, first, whole, each, gap)
                count -= whole * each
            first, free = first + whole, free - whole
            if free and count:
                put(n, first, 1, count, gap)
                count, first, free = 0, first + 1, free - 1
            if free:
                if gap not in gaps:
                    gaps[gap] = []
                    bisect.insort(open_gaps, gap)
                gaps[gap].append((first, free))
    return sorted(runs)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    scratch = Scratch(docs.sparkSession, "pack")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    pieces = scratch.write(source.mapInArrow(
        _pieces(tokenizer_path, capacity, end_id),
        f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("k"))
    histogram = {r["length"]: r["k"] for r in counts.groupBy("length").agg(F.sum("k").alias("k")).collect()}
    runs = np.array(plan_runs(histogram, capacity), dtype=np.int64).reshape(-1, 5)
    order = np.unique(runs[:, 0])
    span = int(max(histogram.values(), default=0)) + 1
    keys = np.searchsorted(order, runs[:, 0]) * span + runs[:, 1]  # runs by (length, first rank)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, np.searchsorted(order, length) * span + rank, side="right") - 1
            run = runs[at] if len(length) else runs[:0]
            past = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")),
                 pa.array(run[:, 2] + past // run[:, 3]), pa.array(run[:, 4] + past % run[:, 3] * length)],
                ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # the rank of a task's first piece of a length among all: a sum over tasks, not over pieces
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first")).drop("first", "part")
    out = ranked.mapInArrow(tidy(place), f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_col)
