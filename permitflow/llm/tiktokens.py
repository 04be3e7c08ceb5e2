"""Operator 13: byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are cut into matches of a pattern, each match is merged by the file's ranks, and ids are decoded to raw bytes:
a token may end inside a character, so bytes are joined before anything reads them as text.

Long texts are encoded in spans, cut only where two matches meet whatever stands around:

* between a character that is no white space and white space after it: no match goes on into white space;
* between an ASCII letter and an ASCII digit, either way round, and between either of them, or a common CJK letter,
  and a punctuation mark after it: no match holds both.

The library's pattern search goes back over a whole run of white space and overflows its stack on runs of about a million.
Runs beyond ``LONG_RUN`` are therefore matched here: followed by other text a run without its last character is one
match, at the end of a text the whole run is one. Spans and their matches are those of the whole text; only
their order of work differs.

Defined results: null text counts as empty, which has no ids and decodes to no bytes. Strings that look like special tokens are
ordinary text. Null and repeated ids and repeated rows pass through, one output row for each input row. An empty table
gives an empty result. Extra columns of any name are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices
from .storage import ship

SPAN = 1 << 17      # characters after which a span ends at the next place that is safe
LONG_RUN = 1 << 14  # white space characters of a run that is matched here

_LETTER = r"A-Za-z0-9ぁ-ゖァ-ヺ一-龥가-힣"
_MARK = r"!-/:-@\[-`{-~、。！，：；？"
_CODERS: dict[tuple[str, str], Coder] = {}


class Coder:
    """Ids of texts and bytes of ids."""

    def __init__(self, rank_file: str, pattern: str):
        import regex
        import tiktoken

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.encoding = tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.safe = regex.compile(rf"(?<=\S)(?=\s)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[{_LETTER}])(?=[{_MARK}])")
        self.run = regex.compile(r"\s{%d,}+" % LONG_RUN)

    def _span(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def spans(self, text: str, start: int, end: int) -> Iterator[str]:
        """text[start:end] in parts; both ends are places where matches meet."""
        while end - start > SPAN:
            found = self.safe.search(text, start + SPAN, end)
            cut = found.start() if found else end
            if cut >= end:
                break
            yield text[start:cut]
            start = cut
        yield text[start:end]

    def encode(self, text: str) -> np.ndarray:
        """The text's ids as unsigned 32-bit integers."""
        if len(text) <= min(SPAN, LONG_RUN):
            return self._span(text)
        parts, start = [], 0
        for run in self.run.finditer(text):
            first, end = run.span()
            end -= end < len(text)  # the last character goes with what follows
            parts += [self._span(s) for s in self.spans(text, start, first) if s]
            parts.append(np.array(self.encoding._encode_single_piece(text[first:end]), dtype=np.uint32))
            start = end
        parts += [self._span(s) for s in self.spans(text, start, len(text)) if s]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def coder(rank_file: str, pattern: str) -> Coder:
    if (rank_file, pattern) not in _CODERS:
        _CODERS[rank_file, pattern] = Coder(rank_file, pattern)
    return _CODERS[rank_file, pattern]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids) per row; ``ids`` holds little-endian unsigned 32-bit integers, as training shards do.

    ``rank_file`` is a path that every node has.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(rank_file, pattern)
        for whole in batches:
            for batch in slices(whole):
                ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                    ["id", "n_tokens", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the raw bytes of its ids in column ``to``; null ids give no bytes."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(rank_file, pattern)
        for whole in batches:
            for batch in slices(whole):
                found = [own.decode(np.frombuffer(x or b"", dtype="<u4")) for x in batch.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, to])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, `{to}` binary")
