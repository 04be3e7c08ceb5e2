"""Words of lines and hashes of runs of words (operator 8)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .shingles import mix, segment_hashes, utf8_buffer

_U = np.uint64
_MUL = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 11, 12, 13, 32]] = True


def lines(texts: pa.Array):
    """Of a batch: word hashes, first word of each non-blank line (and an end), its text and its line number."""
    raw, offsets = utf8_buffer(texts)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), none, none, none, none
    newline = raw == 10
    inside = ~(_SPACE[raw] | newline)
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    breaks = np.concatenate([[0], np.cumsum(newline)])
    text = np.searchsorted(offsets, s, side="right") - 1
    number = breaks[s] - breaks[offsets[text]]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (number[1:] != number[:-1])])) if len(s) else np.zeros(0, np.int64)
    return segment_hashes(raw, s, e), np.concatenate([first, [len(s)]]), text[first], number[first], s, e


class Sums:
    """Hashes of runs of words by prefix sums: a run's hash does not depend on where it stands."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        with np.errstate(over="ignore"):
            self.up = np.concatenate([[_U(1)], np.multiply.accumulate(np.full(n, _MUL, dtype=np.uint64))])
            self.down = np.concatenate([[_U(1)], np.multiply.accumulate(np.full(n, pow(_MUL, -1, 2**64), dtype=np.uint64))])
            self.sums = np.concatenate([[_U(0)], np.cumsum(words * self.up[:n - 1], dtype=np.uint64)])

    def run(self, start, end):
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.down[start]

    def without(self, start, end, at):
        """The hash of words start..end with word ``at`` left out."""
        with np.errstate(over="ignore"):
            return self.run(start, at) + self.run(at + 1, end) * self.up[at - start]


def key(h, *salts) -> np.ndarray:
    with np.errstate(over="ignore"):
        for k, s in enumerate(salts):
            h = mix(h + np.asarray(s).astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(k + 1))
    return h.view(np.int64)
