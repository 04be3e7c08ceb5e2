"""Operator 1's token ids against the tokenizer on whole texts."""

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("word_bpe_49k.json")


def check(own, texts):
    model = tokenizers.Tokenizer.from_file(PATH)
    ids, bounds = own.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == model.encode(text or "", add_special_tokens=False).ids, text


def test_letters_whose_lower_case_is_longer_or_special():
    from permitflow.llm.packing import WordIds
    letters = [c for c in map(chr, range(0x80, 0x11000)) if c.isalpha() and (len(c.lower()) > 1 or len(c.upper()) > 1 or c.lower() != c.casefold())]
    marked = [f"{c}, {c}." for c in map(chr, range(0x80, 0x2100)) if c.isalnum()]
    assert "İ" in letters
    check(WordIds(PATH), ["BELEDİYESİ, ANKARA", None, "", *(f"A{c}, {c}. x{c}{c}, B{c}b. {c}" for c in letters), *marked])


def test_words_that_share_a_hash(monkeypatch):
    from permitflow.llm import packing
    real = packing.segment_hashes
    monkeypatch.setattr(packing, "segment_hashes", lambda raw, starts, ends: real(raw, starts, ends) % np.uint64(50))
    own = packing.WordIds(PATH)
    check(own, [f"word{i} other{i * 7}" for i in range(100)])
    check(own, ["alone"])
    check(own, ["one", None, "two three"])


def test_edges_of_words():
    from permitflow.llm.packing import _edges
    raw = np.frombuffer(b"a abcdefgh abcdefghi", dtype=np.uint8)
    found = _edges(raw, np.array([0, 2, 11]), np.array([1, 10, 20]))
    number = lambda b: int.from_bytes(b, "little")
    assert found.tolist() == [[number(b"a")] * 2, [number(b"abcdefgh")] * 2, [number(b"abcdefgh"), number(b"bcdefghi")]]


def test_batches_are_small_enough_for_idle_workers(monkeypatch):
    import pyspark
    from types import SimpleNamespace
    from permitflow.llm import packing
    sizes, real = [], packing.WordIds.encode
    monkeypatch.setattr(packing.WordIds, "encode", lambda self, texts: sizes.append(texts.nbytes) or real(self, texts))
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [f"text{i} " * 3000 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], ["id", "text"])
    out = pa.Table.from_batches(packing._pieces(PATH, 4096, 1)(iter([batch])))
    assert sum(sizes) >= sum(map(len, texts)) > 6 << 20 and max(sizes) < 1.1 * (1 << 20)
    model = tokenizers.Tokenizer.from_file(PATH)
    length = dict.fromkeys(range(300), 0)
    for doc, n in zip(out["id"].to_pylist(), out["length"].to_pylist()):
        length[doc] += n
    assert [length[i] for i in (0, 150, 299)] == [len(model.encode(texts[i], add_special_tokens=False).ids) + 1 for i in (0, 150, 299)]


def test_words_come_in_many_batches():
    from permitflow.llm.packing import WordIds
    own = WordIds(PATH)
    for k in range(40):
        check(own, [f"a{k}b{i} c{i * k}." for i in range(k, k + 30)])
    assert len(own.hashes) == own.number.max() + 1 > 500


def test_plain_words_are_encoded_in_rows(monkeypatch):
    from permitflow.llm.packing import WordIds
    own, singly, real = WordIds(PATH), [], WordIds._of
    monkeypatch.setattr(WordIds, "_of", lambda self, words: singly.extend(words) or real(self, words))
    plain = [f"Word{i}x w{i}, end&& 3.14 a-b_c/d x2y ...!? (q) {i * 977}" for i in range(900)]
    check(own, [*plain, "  \t lead", "", None, "tail \n"])
    assert not singly
    other = ["don't", "it's,", "a<|endoftext|>b", "<|endoftext|>", "x<y", "</w>", "q\x00r", "\x7f", "naïve", "e\u0301t\u0301", "日本語。", "\x1ca", "''s", "4's5"]
    check(own, [" ".join(other), "so it's plain&& don't, naïve <x> end"])
    assert {*other} <= {*singly} and "end" not in singly


def test_rows_that_another_tokenizer_cuts_otherwise():
    from permitflow.llm.packing import WordIds
    own = WordIds(PATH)
    own.closes[:] = False
    check(own, ["these words close nothing", "a-b. c3"])
