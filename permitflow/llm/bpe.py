"""Operator 5: token counts by byte-pair merging with a heap over a linked list.

The vocabulary file gives pieces with scores; a piece's rank is its score, best first. A chunk of text is a
linked list of symbols, one for each character. The heap holds the adjacent pairs that form a piece, by rank
and then from the left; the best pair is popped and merged until none is left. The count is the number of
initial symbols less the merges; a character outside the vocabulary starts as one symbol for each of its UTF-8
bytes, as byte fallback spells it. No ids are made.

A text is cut where no piece can span: before a run of word marks, and round characters that no piece of two
or more characters holds. Chunks repeat, so their counts are kept in a table of bounded size per Python worker.

Defined results: null text counts as empty: 0 bytes, 0 tokens. Null and repeated ids pass through, one output
row for each input row. An empty table gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices
from .storage import ship

MARK = "▁"
KEPT_CHUNKS = 400_000  # chunks whose counts one worker keeps; the table starts anew when it is full
KEPT_LENGTH = 32       # characters of the longest chunk that is kept

_MODELS: dict[str, PieceCounter] = {}


class PieceCounter:
    """Counts the tokens that a piece vocabulary gives a text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                self.score[model.id_to_piece(i)] = -model.get_score(i)
        assert not any(MARK in p.lstrip(MARK) for p in self.score), "a piece spans words"
        self.prefix = model.normalize("x").startswith(MARK)
        joined = {c for p in self.score if len(p) > 1 for c in p}
        # a character that no longer piece holds stands alone
        self.cut = re.compile(f"{MARK}*[^{MARK}]*") if MARK in joined else re.compile("(?s).+")
        alone = "".join(c for c in "\t\n\r\x0b\x0c" if c not in joined)
        self.alone = re.compile(f"[{alone}]") if alone else None  # one byte each: one token each, and they part their neighbours
        self.known: dict[str, int] = {}

    def merge(self, chunk: str) -> int:
        score = self.score
        symbols = list(chunk)
        n = len(symbols)
        count = sum(1 if c in score else len(c.encode("utf-8")) for c in symbols)
        if n < 2:
            return count
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = score.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                heap.append((rank, i, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            left = symbols[i]
            if not left:
                continue
            j = after[i]
            if j >= n or len(left) >= len(piece) or left + symbols[j] != piece:
                continue
            symbols[i], symbols[j] = piece, ""
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = score.get(piece + symbols[k])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, piece + symbols[k]))
            h = before[i]
            if h >= 0:
                rank = score.get(symbols[h] + piece)
                if rank is not None:
                    heapq.heappush(heap, (rank, h, symbols[h] + piece))
        return count

    def _chunk(self, chunk: str) -> int:
        count = self.known.get(chunk)
        if count is None:
            count = self.merge(chunk)
            if len(chunk) <= KEPT_LENGTH:
                if len(self.known) >= KEPT_CHUNKS:
                    self.known.clear()
                self.known[chunk] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        lines = self.alone.split(text) if self.alone else [text]
        total = len(lines) - 1
        known = self.known
        for k, line in enumerate(lines):
            first = k == 0 and self.prefix
            if MARK in line or "  " in line or line.startswith(" ") or line.endswith(" "):
                line = (MARK if first else "") + line.replace(" ", MARK)
                chunks = [c for c in self.cut.findall(line) if c]
            else:
                chunks = (" " + line if first or line == "" else line).replace(" ", " " + MARK).split(" ")
                if not chunks[0]:
                    del chunks[0]
                if line == "" and not first:
                    chunks = []
            for chunk in chunks:
                n = known.get(chunk)
                total += self._chunk(chunk) if n is None else n
        return total


def counter(path: str) -> PieceCounter:
    if path not in _MODELS:
        _MODELS[path] = PieceCounter(path)
    return _MODELS[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; ``model_path`` is a piece vocabulary that every node has."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_path)
        for whole in batches:
            for batch in slices(whole):
                counts = [model.count(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
