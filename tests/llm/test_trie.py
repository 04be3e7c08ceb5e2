"""Operator 12 against a dictionary of all prefixes, with parts of every size."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

pytest.importorskip("public_tokenizers")


def brute(convs):
    """The trie of {conv_id: [(role, text)]}."""
    members, children = defaultdict(set), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(path))))
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]), leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    """The contract's conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
DDL = "conv_id bigint, turn bigint, role string, text string"


def found_in(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def odd_rows(seed, convs, kinds=4, longest=9):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(3 * convs), convs):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice([None, "", "é你", "a long first turn of many", *(f"t{k}" for k in range(kinds))]) if rng.random() < 0.7 else "same"
            rows.append((c, None if turn == 0 and rng.random() < 0.2 else turn, rng.choice(["user", "user", None, "assistant"]), text))
    return rows


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_trie_of_parts(spark, monkeypatch, parts):
    from permitflow.llm import trie
    monkeypatch.setattr(trie, "default_parallelism", lambda spark: parts)
    monkeypatch.setattr(trie, "CHUNK", 3)
    rows = odd_rows(parts, 150, kinds=2, longest=5) + [(1000 + k, t, "user", "same") for k in range(40) for t in range(6)] + [(5000, t, "user", f"long {t % 3}") for t in range(700)]
    df = spark.createDataFrame(rows, DDL).repartition(4)
    convs = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1])):
        convs[c].append((role or "", text or ""))
    assert found_in(trie.prefix_trie(trie.conversation_keys(df))) == brute(convs)


def test_query(spark, tmp_path):
    from permitflow.llm.oracle import PREFIX_TRIE
    from permitflow.llm.queries import QUERIES
    rows = odd_rows(7, 250) + [(None, 1, "user", "x"), (400, 0, "user", "only"), (400, 0, "user", "only")]
    spark.createDataFrame([(*r, "clash") for r in rows], DDL + ", key string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = found_in(QUERIES["op12_prefix_trie"](spark, str(tmp_path)))
    assert found == brute(rebuilt(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert found == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({PREFIX_TRIE})").fetchall(), key=repr)


def test_empty_table_and_turnless_conversations(spark, tmp_path):
    from permitflow.llm.queries import QUERIES
    from permitflow.llm.trie import prefix_trie
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/conversations.parquet")
    assert found_in(QUERIES["op12_prefix_trie"](spark, str(tmp_path))) == []
    keys = spark.createDataFrame([(5, b""), (3, b"")], "conv_id bigint, key binary")
    assert found_in(prefix_trie(keys)) == brute({3: [], 5: []})


def test_layouts_grow():
    from permitflow.llm.art import Tree
    rng, tree, keys = random.Random(1), Tree(), set()
    while len(keys) < 3000:
        keys.add(bytes([rng.randrange(256), *rng.choices(range(3), k=rng.choice([2, 5])), *rng.choices(range(60), k=rng.randint(0, 3))]))
        keys.add(bytes([7, rng.randrange(30), rng.randrange(9)]))
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key)
    held, layouts, stack = [], set(), [(b"", tree.root)]
    while stack:
        path, node = stack.pop()
        path += node.prefix
        layouts.add(node.layout)
        own = list(node.items())
        assert [b for b, _ in own] == sorted({b for b, _ in own}) and len(own) <= node.layout
        assert all(node.child(b) is child for b, child in own)
        if node.end is not None:
            assert node.end == path
            held.append(path)
        else:
            assert len(own) > 1 or node is tree.root
        stack += [(path + bytes([b]), child) for b, child in own]
    assert sorted(held) == sorted(keys) and layouts == {4, 16, 48, 256}
