"""Operator 9: planted personal data and secrets among decoys; what the method adds, and how often it is right."""

import random

import pytest

pytest.importorskip("public_tokenizers")


def luhn(digits):
    total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return digits + str(-total % 10)


def planted(seed, n=600):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiourstnlmk") for _ in range(rng.randint(2, 14)))
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k - 2)) + "a1"
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    real = [lambda: ("email", f"{word()}.{digits(2)}@{word()}.com"), lambda: ("ip", f"{rng.randint(1, 120)}.{rng.randint(0, 255)}.0.{rng.randint(1, 255)}"),
            lambda: ("card", luhn("4" + digits(14))), lambda: ("phone", f"+1 ({rng.randint(200, 999)}) 555-{digits(4)}"),
            lambda: ("secret", f'token = "{hexa(40)}"'), lambda: ("secret", f"password={hexa(18)}"), lambda: ("secret", "AKIA" + hexa(16).upper())]
    false = [lambda: digits(16), lambda: f"commit {hexa(40)}", lambda: f"{digits(2)}.{digits(1)}", lambda: word() + word() + word(), lambda: "999.300.1.1", lambda: digits(7)]
    rows = []
    for i in range(n):
        words, kinds = [word() for _ in range(rng.randint(10, 60))], set()
        if i % 2:
            for _ in range(rng.randint(1, 3)):
                kind, value = rng.choice(real)()
                kinds.add(kind)
                words.insert(rng.randint(1, len(words)), value)
        else:
            words.insert(rng.randint(1, len(words)), rng.choice(false)())
        rows.append((i, " ".join(words), kinds))
    return rows


def test_planted_documents_are_found_and_decoys_left(spark):
    from permitflow.llm.pii import KINDS, find_spans, span_report
    rows = planted(1)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in span_report(df).collect()}
    flagged = {i for i, r in found.items() if r.n_spans > 0}
    real = {i for i, _, kinds in rows if kinds}
    assert len(flagged & real) / len(real) >= 0.98 and len(flagged & real) / len(flagged) >= 0.95
    for kind in KINDS:  # a number right beside another makes one base match, which fails its check
        own = [i for i, _, kinds in rows if kind in kinds]
        assert sum(found[i][f"n_{kind}"] > 0 for i in own) / len(own) >= 0.95
    secrets = {i for i, r in found.items() if r.n_secret > 0}
    held = {i for i, _, kinds in rows if "secret" in kinds}
    assert len(secrets & held) / len(held) >= 0.98 and len(secrets & held) / len(secrets) >= 0.95
    numbered, spans = find_spans(df)
    text = {i: t for i, t, _ in rows}
    added = [(text[r.id][r.start:r.end], r.value) for r in spans.filter("NOT base").join(numbered, "row").collect()]
    assert len(added) >= len(held) and all(a == b for a, b in added)


def test_redaction_covers_secrets(spark):
    from permitflow.llm.pii import redact
    rows = planted(2, 300) + [(1000, 'a token = "0123456789abcdef0123456789abcdef01234567" b', {"secret"})]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in redact(df).collect()}[1000] == 'a token = "[secret]" b'
