"""Operator 8 against a search over all earlier lines; rows with null and repeated ids; columns of clashing names."""

import random
import re

import pytest

pytest.importorskip("public_tokenizers")


def words(line):
    return re.findall(r"[^\x20\x09\x0B-\x0D]+", line)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(docs, least=6):
    """docs: texts in order -> (document, line): kind. Lines that were dropped as near copies still count as earlier lines."""
    seen, out = [], {}
    for d, text in enumerate(docs):
        for n, line in enumerate((text or "").split("\n")):
            w = words(line)
            if not w:
                continue
            if any(w == x for x in seen):
                out[d, n] = "exact"
                continue
            if len(w) >= least and any(len(x) >= least and one_edit(w, x) for x in seen):
                out[d, n] = "near"
            seen.append(w)
    return out


def texts_of(seed, n=60):
    rng, lines = random.Random(seed), [[f"w{random.Random(k).randrange(9)}{j}" for j in range(random.Random(k + 7).randint(3, 12))] for k in range(25)]
    out = []
    for _ in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                i = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(i, f"x{rng.randrange(3)}"), lambda: w.insert(i, f"y{rng.randrange(3)}"), lambda: len(w) > 2 and w.pop(i)])()
            own.append(rng.choice([" ", "  ", "\t"]).join(w) if rng.random() > 0.1 else rng.choice(["", " ", "z"]))
        out.append("\n".join(own) if rng.random() > 0.05 else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_earlier_lines(spark, seed):
    from permitflow.llm.line_dedup import duplicate_lines, line_report
    texts = texts_of(seed)
    df = spark.createDataFrame([(10 * i - 300, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    want = {(10 * d - 300, n): k for (d, n), k in brute(texts).items()}
    assert {(r[0], r[1]): r[2] for r in duplicate_lines(df).collect()} == want and len(want) > 40
    for r in line_report(df).collect():
        own = {n: k for (d, n), k in want.items() if d == r.doc_id}
        assert r.dropped == sorted(own) and (r.n_exact, r.n_near) == tuple(list(own.values()).count(k) for k in ("exact", "near"))


def test_rows_with_null_and_repeated_ids_keep_their_clean_lines(spark):
    from permitflow.llm.line_dedup import drop_lines, line_report
    rows = [(1, "one two three four five six"), (None, "one two three four five six\nkeep A"), (None, "a line that is clean and unique\nkeep B"), (None, "a line\nkeep B")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert [(r.doc_id, r.text) for r in sorted(drop_lines(df).collect(), key=lambda r: (r.doc_id is None, r.text))] == [
        (1, "one two three four five six"), (None, "a line"), (None, "a line that is clean and unique\nkeep B"), (None, "keep A")]
    assert line_report(df).count() == 4
    again = spark.createDataFrame([(7, "x y\nu v"), (7, "x y\nnew"), (7, "x y\nu v"), (3, "u v"), (8, "new\nlast")], "doc_id bigint, text string").coalesce(1)
    assert sorted((r.doc_id, r.text) for r in drop_lines(again).collect()) == [(3, "u v"), (7, ""), (7, "new"), (7, "x y"), (8, "last")]


def test_random_rows_with_few_ids(spark, tmp_path):
    from permitflow.llm.line_dedup import drop_lines
    rng, texts = random.Random(9), texts_of(5, 80)
    rows = [(rng.choice([None, 1, 2, 2, 5, 2**63 - 1, -(2**63), 10 + i]), i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, place int, text string").coalesce(1).write.parquet(f"{tmp_path}/docs.parquet")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    gone = brute([t for _, _, t in order])
    want = {place: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, (_, place, t) in enumerate(order)}
    found = drop_lines(spark.read.parquet(f"{tmp_path}/docs.parquet"))
    assert found.columns == ["doc_id", "place", "text"] and {r.place: r.text for r in found.collect()} == want


def test_columns_of_clashing_names(spark):
    from permitflow.llm.line_dedup import drop_lines
    names = ["row", "id", "line", "own", "pos", "number", "dropped", "doc", "_row", "_row_", "kind"]
    df = spark.createDataFrame([(1, "a b\nc d", *range(11)), (2, "c d\ne", *range(11))], "doc_id bigint, text string, " + ", ".join(f"{n} int" for n in names))
    found = drop_lines(df)
    assert found.columns == df.columns and {tuple(r) for r in found.collect()} == {(1, "a b\nc d", *range(11)), (2, "e", *range(11))}


def test_empty_table(spark):
    from permitflow.llm.line_dedup import drop_lines
    assert drop_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
