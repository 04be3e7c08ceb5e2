"""Word and shingle hashes of whole batches of texts, computed with numpy.

A batch of texts is one UTF-8 byte buffer. Words are ``[^\\x20\\x09-\\x0D]+`` after
A-Z is lower-cased (bytes, so no other letter changes). A word's hash is a
polynomial over random 64-bit byte values, taken from prefix sums of the buffer,
so no word is ever built as a Python object. A shingle's hash mixes the hashes of
``width`` successive words of one text.

All values are exact functions of the words: equal shingles get equal hashes in
every task. Different shingles share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(_RNG.integers(2**62, 2**63, dtype=np.uint64)) * 2 + 1
_INV = pow(_BASE, -1, 2**64)
_SLOT = _RNG.integers(1, 2**63, size=64, dtype=np.uint64) * _U(2) + _U(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class _Powers:
    """Growing tables of the powers of the base and of its inverse, modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", _INV)):
                    table = np.full(size, base, dtype=np.uint64)
                    table[0] = 1
                    setattr(self, name, np.multiply.accumulate(table))
        return self.up, self.down


_POWERS = _Powers()


def utf8_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of raw[start:end] for every (start, end); independent of where the segment stands."""
    n = len(raw)
    up, down = _POWERS.get(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of all words in order, words per text); a text's bytes are raw[offsets[i]:offsets[i+1]]."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.diff(np.searchsorted(s, offsets))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, words per text), A-Z lower-cased."""
    starts, ends, per_text = word_bounds(raw, offsets)
    return segment_hashes(_LOWER[raw], starts, ends), per_text


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of words[i:i + width] for every i; those that reach beyond the end are padded."""
    out, made = words, 1
    with np.errstate(over="ignore"):
        for bit in bin(width)[3:]:  # double, and add one word where the width asks for it
            ahead = np.concatenate([out[made:], np.zeros(min(made, len(out)), np.uint64)])
            out, made = mix(out * _SLOT[0] + ahead * _SLOT[1] + _U(made)), 2 * made
            if bit == "1":
                ahead = np.concatenate([words[made:], np.zeros(min(made, len(words)), np.uint64)])
                out, made = mix(out * _SLOT[2] + ahead * _SLOT[3] + _U(made)), made + 1
    return out


def shingle_sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text i's distinct shingle hashes, ascending, are hashes[bounds[i]:bounds[i+1]].

    A text with 1 to width-1 words has one shingle, its whole word sequence; one without words has none.
    """
    raw, offsets = utf8_buffer(texts)
    words, per_text = word_hashes(raw, offsets)
    word_at = np.concatenate([[0], np.cumsum(per_text)])
    count = np.where(per_text >= width, per_text - width + 1, np.minimum(per_text, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    total = int(bounds[-1])
    owner = np.repeat(np.arange(len(per_text)), count)
    at = np.arange(total) - bounds[owner] + word_at[owner]
    length = np.minimum(per_text[owner], width)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    out = length.astype(np.uint64) * _SLOT[-1]
    with np.errstate(over="ignore"):
        for k in range(width):
            w = padded[at + k] * _SLOT[k]
            out += np.where(k < length, mix(w), _U(0)) * _SLOT[k + 32]
    out = mix(out)
    kept, sizes = [], np.zeros(len(per_text), np.int64)
    for i in np.flatnonzero(count):
        distinct = np.unique(out[bounds[i]:bounds[i + 1]])
        kept.append(distinct)
        sizes[i] = len(distinct)
    return (np.concatenate(kept) if kept else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])
