"""Operator 11 against a search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

pytest.importorskip("public_tokenizers")


def brute_runs(text, least=24, power=3):
    n, found = len(text), {}
    for q in range(1, n // power + 1):  # a multiple of a period comes later and finds the same stretch
        i = 0
        while i + q < n:
            j = i
            while j + q < n and text[j] == text[j + q]:
                j += 1
            if j + q - i >= max(least, power * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def odd_words(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        size, kinds = rng.randint(0, 200), rng.choice([1, 2, 3, 5, 50])
        text = [rng.randrange(kinds) for _ in range(size)]
        for _ in range(rng.randint(0, 4) if size > 10 else 0):
            a, p = rng.randrange(size), rng.randint(1, min(30, size // 3))
            for i in range(a + p, a + rng.randint(1, size - a)):
                text[i] = text[i - p]
        yield text


@pytest.mark.parametrize("least, power", [(24, 3), (8, 3), (12, 4)])
def test_runs_of(least, power):
    from permitflow.llm.runs import runs_of
    total = 0
    for text in odd_words(700, least):
        found = runs_of(text, least, power)
        assert found == brute_runs(text, least, power)
        total += len(found)
    assert total > 300


def test_repair_derives_the_text():
    from permitflow.llm.runs import repair
    for text in odd_words(200, 9):
        symbols = max(text, default=-1) + 1
        rules, rest = repair(text, symbols)
        spell = [[i] for i in range(symbols)]
        for a, b, first in rules:
            spell.append(spell[a] + spell[b])
            assert text[first:first + len(spell[-1])] == spell[-1]
        assert [w for s, _ in rest for w in spell[s]] == text
        pairs = [(a, b) for (a, _), (b, _) in zip(rest, rest[1:])]
        assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_long_periodic_texts():
    from permitflow.llm.runs import runs_of
    assert runs_of([0] * 300_000) == [(0, 300_000, 1)]
    assert runs_of([9001] + [i % 9000 for i in range(40_000)]) == [(1, 40_000, 9000)]


def spell(words):
    return " ".join(f"w{w}" for w in words)


def test_periodic_runs_of_texts(spark):
    from permitflow.llm.runs import periodic_runs
    texts = [spell(t) for t in odd_words(250, 3)] + [None, "", " \n", "x " * 30, "X x " * 30, "a\x1cb " * 40, "é 你好\t" * 20 + " é", "z " * 23, "z " * 24]
    df = spark.createDataFrame([(None if i % 9 == 0 else i // 2, i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, row bigint, text string, runs string").repartition(3)
    found = periodic_runs(df, id_col="row").collect()
    assert len(found) == len(texts)
    for r in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.row] or "")
        runs = brute_runs(words)
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_query(spark, tmp_path):
    from permitflow.llm.queries import QUERIES
    real = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = real + [(10**9 + i, spell(t)) for i, t in enumerate(odd_words(150, 4))] + [(None, "a b " * 20), (10**8, None), (10**8, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=repr)
    want, rebuilt = [], 0
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(d).encode()) if d is not None else 1, len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, rebuilt = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)], rebuilt + 1
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((d, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert rebuilt > 20 and found == sorted(want, key=repr)
    empty = f"{tmp_path}/none"
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{empty}/documents.parquet")
    assert QUERIES["op11_periodic_runs"](spark, empty).count() == 0
