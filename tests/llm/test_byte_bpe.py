"""Operator 13 against the library called on whole texts, and the round trip."""

import base64
import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

FILE = P.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "B", "é", "你好", "。", "ー", "か", "1", "42", "'", "'s", "'ll", "!", "...", " ", "  ", "\n", "\t", "\x85", "\xa0", "　", "\x1c", "😀", "_", "-", "ab c", "​", "<|endoftext|>", "٣", "ﬁ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_query_equals_the_library_and_comes_back(spark, library):
    from permitflow.llm.tiktokens import decode, encode
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts = real + odd_texts(300, 1) + [None, "", "", "x" * 200_000, "w1 " * 90_000, " \n" * 30_000 + "end", " " * 50_000, "你好" * 100_000, "a'sb" * 70_000]
    df = spark.createDataFrame([(i % 50 if i % 7 else None, i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, row bigint, text string, ids string").repartition(3)
    found = decode(encode(df, FILE, P.PATTERN, id_col="row"), FILE, P.PATTERN).collect()
    assert len(found) == len(texts)
    for r in found:
        want = library.encode_ordinary(texts[r.row] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == (texts[r.row] or "").encode()


def test_spans_are_cut_where_matches_meet(library, monkeypatch):
    from permitflow.llm import tiktokens
    monkeypatch.setattr(tiktokens, "SPAN", 5)
    monkeypatch.setattr(tiktokens, "LONG_RUN", 3)
    own, cut = tiktokens.Coder(FILE, P.PATTERN), 0
    for text in odd_texts(4000, 2):
        assert own.encode(text).tolist() == library.encode_ordinary(text), text
        cut += len(list(own.spans(text, 0, len(text)))) > 1
    assert cut > 1000


def test_runs_of_white_space_that_the_library_cannot_search(library):
    from permitflow.llm.tiktokens import Coder
    own = Coder(FILE, P.PATTERN)
    for text in ("x" + " " * 2_000_000, "x" + " " * 2_000_000 + "y", "\n" * 1_500_000 + "z"):
        ids = own.encode(text)
        assert own.decode(ids) == text.encode()
        tail = [] if text[-1] == " " else library.encode_ordinary(text.lstrip("x")[-2:])
        assert ids[len(ids) - len(tail):].tolist() == tail


def test_query_columns(spark, tmp_path, library):
    from permitflow.llm.queries import QUERIES
    spark.createDataFrame([(1, "Hello  wörld"), (None, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_byte_bpe"](spark, str(tmp_path)).collect()}
    ids, sha = library.encode_ordinary("Hello  wörld"), lambda b: hashlib.sha256(b).hexdigest()
    assert found == {1: (len(ids), sha(np.array(ids, "<u4").tobytes()), sha("Hello  wörld".encode())), None: (0, sha(b""), sha(b""))}
    empty = f"{tmp_path}/none"
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{empty}/documents.parquet")
    assert QUERIES["op13_byte_bpe"](spark, empty).count() == 0
