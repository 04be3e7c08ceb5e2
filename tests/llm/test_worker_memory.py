"""What reused Python workers keep between tasks."""

from types import SimpleNamespace

import pyarrow as pa
import pytest


def test_released_after_the_last_batch(monkeypatch):
    from permitflow.llm import batches
    done = []
    pool = lambda name: SimpleNamespace(release_unused=lambda: done.append(name))
    monkeypatch.setattr(batches, "pa", SimpleNamespace(default_memory_pool=lambda: pool("arrow"), system_memory_pool=lambda: pool("system")))
    out = batches.tidy(lambda given: (x + 1 for x in given))(iter([1, 2]))
    assert next(out) == 2 and not done
    assert list(out) == [3] and done == ["arrow", "system"]


def test_an_idle_worker_keeps_no_tokenizer(monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    import gc
    import pyspark
    from permitflow.llm import packing
    monkeypatch.setattr(pyspark, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a text"])], ["id", "text"])
    assert sum(b.num_rows for b in packing._pieces(P.path("word_bpe_49k.json"), 4096, 1)(iter([batch]))) == 1
    gc.collect()
    assert not [x for x in gc.get_objects() if isinstance(x, packing.WordIds)]


def test_language_parts_are_small():
    pytest.importorskip("numpy")
    import pyarrow.compute  # noqa: F401
    from permitflow.llm.langid import _parts
    texts = ["x" * 20_000] * 100 + ["y" * 900_000, None, "z"]
    parts = list(_parts(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 2 * (1 << 18) for p in parts[:-1])
