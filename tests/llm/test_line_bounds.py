"""Operator 8 with larger edit bounds, against a search over all earlier lines."""

import random

import pytest

pytest.importorskip("public_tokenizers")

from test_line_dedup import texts_of, words  # noqa: E402


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(docs, edits, least):
    seen, out = [], {}
    for d, text in enumerate(docs):
        for n, line in enumerate((text or "").split("\n")):
            w = words(line)
            if not w:
                continue
            if w in seen:
                out[d, n] = "exact"
                continue
            if len(w) >= least and any(len(x) >= least and distance(w, x) <= edits for x in seen):
                out[d, n] = "near"
            seen.append(w)
    return out


def test_within():
    from permitflow.llm.line_neighbours import within
    rng = random.Random(1)
    for _ in range(5000):
        a, b = ([rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2))
        for k in (1, 2, 3):
            assert within(a, b, k) == (distance(a, b) <= k)


@pytest.mark.parametrize("edits, least", [(1, 6), (2, 6), (2, 3), (3, 4)])
def test_bounds_against_all_earlier_lines(spark, edits, least):
    from permitflow.llm.line_dedup import duplicate_lines
    texts = texts_of(edits + 10, 50)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {(r.doc_id, r.line): r.kind for r in duplicate_lines(df, min_words=least, edits=edits).collect()}
    assert found == brute(texts, edits, least)


def test_bound_of_none_is_refused(spark):
    from permitflow.llm.line_dedup import line_report
    with pytest.raises(ValueError):
        line_report(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), edits=0)
