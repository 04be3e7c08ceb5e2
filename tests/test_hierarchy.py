"""H1 against a breadth-first search, and its number of rounds on long chains."""

import logging
import random
import re

import pytest


def brute(rows, edges):
    known, seeds, children = {}, set(), {}
    for k, v in rows:
        if v is None:
            seeds.add(k)
        else:
            known[k] = min(v, known.get(k, v))
    for p, c in edges:
        if p is not None and c is not None:
            children.setdefault(p, set()).add(c)
    out = {}
    for s in seeds:
        seen, front = {s}, {s}
        while front:
            front = {c for p in front for c in children.get(p, ())} - seen
            seen |= front
            hits = [known[c] for c in front if c in known]
            if hits:
                out[s] = min(hits)
                break
    return out


def found(spark, rows, edges):
    from permitflow.operators.hierarchy import nearest_relative_value
    df = spark.createDataFrame(rows, "RecordNumber string, WAP string")
    e = spark.createDataFrame(edges, "ParentRecordNumber string, ChildRecordNumber string")
    got = nearest_relative_value(df, e).collect()
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1] for r in got}


@pytest.mark.parametrize("seed, nodes, edges, known", [(1, 40, 50, 8), (2, 40, 90, 5), (3, 60, 60, 4), (4, 25, 25, 2), (5, 30, 200, 1)])
def test_random_graphs(spark, seed, nodes, edges, known):
    rng = random.Random(seed)
    name = lambda: f"P{rng.randrange(nodes)}"
    links = [(name(), name()) for _ in range(edges)] + [(None, "P1"), ("P1", None)]
    rows = [(name(), f"W{rng.randrange(20)}") for _ in range(known)] + [(f"P{i}", None) for i in range(0, nodes, 2)]
    assert found(spark, rows, links) == brute(rows, links)


def test_cycles_back_to_a_value_of_its_own(spark):
    rows = [("A", None), ("A", "W1"), ("D", "W9"), ("E", None), ("E", "W5")]
    links = [("A", "B"), ("B", "A"), ("B", "C"), ("C", "D"), ("E", "F"), ("F", "E")]
    assert found(spark, rows, links) == brute(rows, links) == {"A": "W9"}


def test_a_long_chain_takes_few_rounds(spark, caplog):
    n = 2000
    links = [(f"P{i:05d}", f"P{i + 1:05d}") for i in range(n)] + [(f"C{i}", f"C{(i + 1) % 700}") for i in range(700)]
    rows = [(f"P{i:05d}", None) for i in range(0, n, 97)] + [(f"P{n:05d}", "W1"), ("C3", None)]
    with caplog.at_level(logging.INFO, logger="permitflow.operators.hierarchy"):
        assert found(spark, rows, links) == {f"P{i:05d}": "W1" for i in range(0, n, 97)}
    rounds = [int(m.group(1)) for m in re.finditer(r"walk round (\d+)", caplog.text)]
    assert 5 <= max(rounds) <= 13


def test_deep_and_branching(spark):
    links = [(f"T{i}", f"T{2 * i}") for i in range(1, 128)] + [(f"T{i}", f"T{2 * i + 1}") for i in range(1, 128)]
    rows = [("T1", None), ("T2", None), ("T3", None), ("T255", "W3"), ("T200", "W2"), ("T130", "W7")]
    assert found(spark, rows, links) == brute(rows, links)
