"""Operator 11: periodic runs by grammar compression.

A run is a stretch of consecutive words with smallest period q and at least ``max(least, power * q)`` words that no
neighbouring word extends while it keeps that period. A collapsed text keeps the first q words of each run.

1. Only repeated stretches can hold a run: words of a run of length L recur q words on, so it is covered by windows of
   ``least - least // power`` words that occur twice in the text. Window hashes of a whole batch of texts are sorted
   together; the words of recurring windows stay, parted by marks of their own. A clash of hashes keeps words in vain.
2. Re-Pair: the most frequent pair of adjacent word ids (of equals the oldest) becomes a nonterminal, until none
   occurs twice. A balanced tree over what is left makes every gap between two words the boundary of one node.
3. The runs that cross a nonterminal's boundary are computed once, in its first expansion. A run has at least half of its
   words on one side, so the few words next to the boundary recur one period away: the places of those words are
   the only periods to try, and each is extended by comparing slices that double in length. Of the
   multiples of a period only the period itself is tried.
4. Runs of a nonterminal are translated to all places of its derivation; those of one period that overlap in a
   period or more are one run. A run lies whole in one node, the lowest that covers it, so what is left is maximal.

Defined results: null text, or text without words, has no words and no runs. Null and repeated ids and repeated rows
pass through, one output row for each input row. An empty table gives an empty result. Extra columns of any name are
ignored. A text is worked on whole in one task; its memory is that of its repeated words.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import slices
from .shingles import mix, segment_hashes, utf8_buffer, window_hashes, word_bounds
from .storage import ship

LEAST, POWER = 24, 3

_U = np.uint64


def repair(text: list[int], symbols: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(rules, rest): rule k makes symbol ``symbols + k`` as (left, right, first position); rest: (symbol, position)."""
    n = len(text)
    base = symbols + n  # above all symbols
    now, after, before = list(text), list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[int, list[int]] = {}
    for i in range(n - 1):
        where.setdefault(now[i] * base + now[i + 1], []).append(i)
    count = {pair: len(places) for pair, places in where.items()}
    heap = [(-k, age, pair) for age, (pair, k) in enumerate(count.items()) if k > 1]
    heapq.heapify(heap)
    age, rules = len(count), []
    while heap:
        least, old, pair = heapq.heappop(heap)
        k = count.get(pair, 0)
        if k < 2:
            continue
        if k != -least:
            heapq.heappush(heap, (-k, old, pair))
            continue
        a, b = divmod(pair, base)
        taken, end = [], -1
        for i in where[pair]:
            if i != end and now[i] == a:
                j = after[i]
                if j < n and now[j] == b:
                    taken.append(i)
                    end = j if a == b else -1
        count[pair], where[pair] = len(taken), taken
        if len(taken) < 2:
            continue
        if len(taken) != k and heap and -heap[0][0] > len(taken):
            heapq.heappush(heap, (-len(taken), old, pair))
            continue
        made, new = symbols + len(rules), {}
        rules.append((a, b, taken[0]))
        del where[pair], count[pair]
        for i in taken:
            j = after[i]
            left, right = before[i], after[j]
            if left >= 0:
                x = now[left] * base
                count[x + a] = count.get(x + a, 0) - 1
                new.setdefault(x + made, []).append(left)
                count[x + made] = count.get(x + made, 0) + 1
            if right < n:
                x = now[right]
                count[b * base + x] = count.get(b * base + x, 0) - 1
                new.setdefault(made * base + x, []).append(i)
                count[made * base + x] = count.get(made * base + x, 0) + 1
                before[right] = i
            now[i], now[j], after[i] = made, -1, right
        where.update(new)
        for pair in new:
            age += 1
            if count[pair] > 1:
                heapq.heappush(heap, (-count[pair], age, pair))
    rest, i = [], 0
    while i < n:
        rest.append((now[i], i))
        i = after[i]
    return rules, rest


def _ahead(text: list[int], x: int, y: int, end: int) -> int:
    """How many items text[x:] and text[y:end] have in common, x < y."""
    start, step = y, 8
    while y < end:
        step = min(step, end - y)
        if text[x:x + step] != text[y:y + step]:
            low, high = 0, step
            while high - low > 1:
                half = (low + high) // 2
                if text[x + low:x + half] == text[y + low:y + half]:
                    low = half
                else:
                    high = half
            return y + low - start
        x, y, step = x + step, y + step, step * 2
    return y - start


def _behind(text: list[int], x: int, y: int, start: int) -> int:
    """How many items text[start:x] and text[:y] have in common from their ends, x < y."""
    end, step = x, 8
    while x > start:
        step = min(step, x - start)
        if text[x - step:x] != text[y - step:y]:
            low, high = 0, step
            while high - low > 1:
                half = (low + high) // 2
                if text[x - half:x - low] == text[y - half:y - low]:
                    low = half
                else:
                    high = half
            return end - x + low
        x, y, step = x - step, y - step, step * 2
    return end - x


class _Crossing:
    """Runs that cross a boundary within a part of the text."""

    def __init__(self, text: list[int], least: int, power: int):
        self.text, self.least, self.power = text, least, power
        self.gram = (least + 1) // 2 - least // power
        codes = np.asarray(text, dtype=np.int64)
        width = 1
        while width < self.gram:  # ranks of ever longer grams; a short one at the end stands for itself
            step = min(width, self.gram - width)
            ahead = np.full(len(codes), -1, dtype=np.int64)
            ahead[:len(codes) - step] = codes[step:]
            codes = np.unique(codes * (int(codes.max(initial=0)) + 2) + ahead + 1, return_inverse=True)[1]
            width += step
        order = np.argsort(codes, kind="stable")
        self.places = order.tolist()
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(codes))]).tolist()
        self.codes = codes.tolist()

    def runs(self, start: int, middle: int, end: int) -> list[tuple[int, int, int]]:
        """(first, end, period), maximal within text[start:end]."""
        text, gram, places = self.text, self.gram, self.places
        widest = (end - start) // self.power
        found: dict[tuple[int, int], int] = {}

        def attempt(x: int, q: int) -> None:
            """Words x on and x + q on agree for ``gram`` words."""
            for (s, e), p in found.items():
                if q % p == 0 and s <= x and x + q + gram <= e:
                    return
            s = x - _behind(text, x, x + q, start)
            e = x + q + _ahead(text, x, x + q, end)
            if e - s >= max(self.least, self.power * q) and s < middle < e:
                found[s, e] = min(q, found.get((s, e), q))

        if middle + gram <= end:
            code = self.codes[middle]
            last = self.bounds[code + 1]
            k = bisect_right(places, middle, self.bounds[code], last)
            while k < last and places[k] <= end - gram and places[k] - middle <= widest:
                attempt(middle, places[k] - middle)
                k += 1
        if middle - gram >= start:
            here = middle - gram
            code = self.codes[here]
            first = self.bounds[code]
            k = bisect_left(places, here, first, self.bounds[code + 1]) - 1
            while k >= first and places[k] >= start and here - places[k] <= widest:
                attempt(places[k], here - places[k])
                k -= 1
        return [(s, e, q) for (s, e), q in found.items()]


def maximal(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(period, start, end) merged where those of one period overlap in a period or more."""
    out: list[tuple[int, int, int]] = []
    for q, s, e in sorted(found):
        if out and out[-1][0] == q and s <= out[-1][2] - q:
            if e > out[-1][2]:
                out[-1] = (q, out[-1][1], e)
        else:
            out.append((q, s, e))
    return out


def runs_of(text: list[int], least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``text`` (small integers), by start, then period."""
    if len(text) < least:
        return []
    symbols = max(text) + 1
    rules, rest = repair(text, symbols)
    length = [1] * symbols
    for a, b, _ in rules:
        length.append(length[a] + length[b])
    crossing = _Crossing(text, least, power)
    own: list[list[tuple[int, int, int]]] = []  # of each rule, from its start
    useful = [False] * (symbols + len(rules))
    for k, (a, b, first) in enumerate(rules):
        size = length[symbols + k]
        own.append([(s - first, e - first, q) for s, e, q in crossing.runs(first, first + length[a], first + size)] if size >= least else [])
        useful[symbols + k] = bool(own[k]) or useful[a] or useful[b]
    found: list[tuple[int, int, int]] = []
    parts = [(0, len(rest))]  # the balanced tree over the rest
    while parts:
        i, j = parts.pop()
        start = rest[i][1]
        end = rest[j][1] if j < len(rest) else len(text)
        if j - i < 2 or end - start < least:
            continue
        half = (i + j) // 2
        found += [(q, s, e) for s, e, q in crossing.runs(start, rest[half][1], end)]
        parts += [(i, half), (half, j)]
    places: dict[int, list[int]] = {}
    for symbol, at in rest:
        if useful[symbol]:
            places.setdefault(symbol, []).append(at)
    for k in range(len(rules) - 1, -1, -1):
        at = places.pop(symbols + k, None)
        if not at:
            continue
        a, b, _ = rules[k]
        for s, e, q in own[k]:
            found += [(q, p + s, p + e) for p in at]
        if useful[a]:
            places.setdefault(a, []).extend(at)
        if useful[b]:
            places.setdefault(b, []).extend([p + length[a] for p in at])
    return sorted((s, e - s, q) for q, s, e in maximal(found))


def _repeated(words: np.ndarray, per_text: np.ndarray, width: int) -> np.ndarray:
    """Which words of a batch lie in a window of ``width`` words that occurs twice in its text."""
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    owner = np.repeat(np.arange(len(per_text)), per_text)
    start = np.flatnonzero(np.arange(len(words)) + width <= bounds[1:][owner]) if len(words) else np.zeros(0, np.int64)
    if not len(start):
        return np.zeros(len(words), dtype=bool)
    with np.errstate(over="ignore"):
        keys = mix(window_hashes(words, width)[start] + owner[start].astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(start), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    at = start[again]
    depth[at] += 1
    np.add.at(depth, at + width, -1)
    return np.cumsum(depth[:-1]) > 0


def _find(least: int, power: int):
    width = least - least // power

    def of_text(words: list[bytes], kept: np.ndarray) -> list[tuple[int, int, int]]:
        ids: dict[bytes, int] = {}
        text, at, mark = [], [], -1
        for i in kept.tolist():
            if at and at[-1] != i - 1:  # another stretch
                text.append(mark)
                at.append(-1)
                mark -= 1
            text.append(ids.setdefault(words[i], len(ids)))
            at.append(i)
        text = [len(ids) - 1 - x if x < 0 else x for x in text]
        return [(at[s], n, q) for s, n, q in runs_of(text, least, power)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for whole in batches:
            for batch in slices(whole):
                raw, offsets = utf8_buffer(batch.column(1))
                starts, ends, per_text = word_bounds(raw, offsets)
                kept = _repeated(segment_hashes(raw, starts, ends), per_text, width)
                bounds, data = np.concatenate([[0], np.cumsum(per_text)]).tolist(), raw.tobytes()
                edges, found, texts = offsets.tolist(), [], []
                for i in range(batch.num_rows):
                    words = data[edges[i]:edges[i + 1]].split()  # of bytes: at ASCII white space only
                    own = np.flatnonzero(kept[bounds[i]:bounds[i + 1]])
                    runs = of_text(words, own) if len(own) >= least else []
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    if runs:
                        dropped = bytearray(len(words))
                        for s, n, q in runs:
                            dropped[s + q:s + n] = b"\1" * (n - q)
                        words = [w for w, gone in zip(words, dropped) if not gone]
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(per_text, pa.int64()), pa.array(found, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """(id, n_words, runs, collapsed) per row: runs as array of (start, length, period) by start, then period.

    Words are ``[^\\x20\\x09-\\x0D]+``; ``collapsed`` is the text's words, joined by one space, without those that
    a run holds after its first period. ``power`` is 3 or more and ``least`` at least twice that.
    """
    if power < 3 or least < 2 * power:
        raise ValueError("power must be 3 or more, and least at least 2 * power")
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(_find(least, power), f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return out.withColumnRenamed("id", id_col)
