"""Operator 7: windows against a brute-force version, numbers with other values, one scan for all lengths."""

import random

from permitflow.llm import decontaminate as D

WORDS = "how many apples does it take to fill the red box when all are gone and what is left for us".split()


def _tokens(text):
    """Tokens of a text in lower case without names: (literal or n, value)."""
    return [("n" if w[0].isdigit() else w, w) for w in text.lower().split()]


def _match(item, doc):
    """Whether a window of the item (13 tokens or all) is in the document, as template or literally."""
    a, b = _tokens(item), _tokens(doc)
    w = min(13, len(a))
    if w < 5:
        return False
    for i in range(len(a) - w + 1):
        for j in range(len(b) - w + 1):
            x, y = a[i:i + w], b[j:j + w]
            if [v for _, v in x] == [v for _, v in y]:
                return True
            n = sum(t == "n" for t, _ in x)
            p = [(u[1], v[1]) for u, v in zip(x, y) if u[0] == "n"]
            if [t for t, _ in x] == [t for t, _ in y] and (2 * n <= w or (w >= 8 and w - n >= 2)) \
                    and len(set(p)) == len({u for u, _ in p}) == len({v for _, v in p}):
                return True
    return False


def test_against_brute_force(spark):
    rng = random.Random(3)
    one = lambda: rng.choice(WORDS) if rng.random() < 0.5 else str(rng.randrange(3, 7))
    items = [" ".join(one() for _ in range(rng.choice([3, 5, 6, 8, 9, 12, 13, 15, 20]))) for _ in range(40)]
    docs = []
    for i in range(200):
        parts = rng.choice(items).split()
        other = {str(d): str(rng.randrange(3, 9)) for d in range(3, 7)} if rng.random() < 0.7 else {}
        text = [other.get(w, w) for w in parts]
        if rng.random() < 0.3:
            text[rng.randrange(len(text))] = one()
        docs.append(" ".join([one() for _ in range(rng.randrange(5))] + text + [one() for _ in range(rng.randrange(5))]))
    found = {r.doc_id: r["items"] for r in D.report(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(3),
                                                    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")).collect()}
    want = {d: [k for k, item in enumerate(items) if _match(item, text)] for d, text in enumerate(docs)}
    assert found == want
    assert sum(map(bool, want.values())) > 50


def test_recall_of_questions_with_other_numbers(spark):
    rng = random.Random(5)
    items, docs = [], []
    for i in range(50):
        n = rng.randrange(8, 14)
        numbers = rng.sample(range(2, 90), n)
        items.append((i, "What is " + " + ".join(map(str, numbers)) + "?"))
        docs.append((i, "Q: what is " + " + ".join(str(x + 100) for x in numbers) + "? Answer below"))
        docs.append((100 + i, "the table holds " + " ".join(str(rng.randrange(2, 90)) for _ in range(40))))
    found = {r.doc_id: i in r["items"] for r in D.report(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                                         spark.createDataFrame(items, "item_id bigint, text string")).collect() for i in [r.doc_id % 100]}
    assert sum(found[i] for i in range(50)) >= 45
    assert not any(found[100 + i] for i in range(50))


def test_texts_are_read_once_for_all_lengths(spark, tmp_path):
    spark.createDataFrame([(1, "how many apples does it take")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    bench = spark.createDataFrame([(k, " ".join(WORDS[:n])) for k, n in enumerate(range(5, 18))], "item_id bigint, text string")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    reads = []
    write = D.Scratch.write

    def seen(self, df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        reads.append(sum("Relation" in line and "doc_id#" in line for line in plan))
        return write(self, df, name)
    D.Scratch.write = seen
    try:
        out = D.contaminated(docs, bench).collect()
    finally:
        D.Scratch.write = write
    assert [(r.doc_id, r["items"]) for r in out] == [(1, [0, 1])]
    assert reads == [0, 0, 1]  # items, windows, hits
